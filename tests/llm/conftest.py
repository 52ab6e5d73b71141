import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " shard string, size string, secrets string, pii string, kept string, start string, budget string, tokens string"
)


@pytest.fixture(scope="session")
def prose():
    """Invented words, seeded."""

    def text(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abdeghilnorstu", k=rng.randint(1, 7))) for _ in range(n))

    return text


@pytest.fixture(scope="session")
def awkward(spark, prose):
    """Documents with NULLs in every column, empty and very long texts, repeated rows, equal
    texts, ties, odd characters, and extra columns named like the operators' own."""
    long_text = prose(1, 30_000)
    texts = [
        None, "", " \t\n ", "one", "a b c d", prose(2, 80), prose(2, 80), long_text,
        "café İstanbul \U0001f600 naïve line\x1cbreak á <|endoftext|> " + prose(3, 70),
        "The The " * 60, "x\n" * 90, prose(4, 200) + " " + prose(5, 60), prose(6, 100) + " " + prose(5, 60),
    ]
    rows = [(i, t, "en" if i % 2 else None, f"src{i}" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, prose(7, 60), "en", "src1", 5), (None, None, None, None, None), (None, None, None, None, None)]
    extra = ("x",) * 8
    return spark.createDataFrame([r + extra for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def texts_of(awkward):
    return sorted(((r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()), key=repr)
