"""The pipeline and the registered queries, against versions without Spark."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from carelake.llm import quality, queries
from carelake.llm.oracles import all_oracles
from checks.run import compare, connect
from tests.llm import test_mixing, test_near_dedup, test_quality, test_secrets

SF = "/root/testdata/sf0.001"
LLM_TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    for t in LLM_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(all_oracles()))
def test_queries_with_sql(spark, duck, name):
    got = queries.all_queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    assert compare(got, duck.execute(all_oracles()[name]).df()) == "ok"


def test_all_are_registered():
    names = contract.queries()
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))


def votes(text):
    m = dict(zip(test_quality.NAMES, test_quality.plain(text)))
    m["n_letters"] = sum(c.isalpha() for c in text or "")
    out = []
    for r in quality.RULES:
        if not m[r.whole]:
            out.append(0)
            continue
        ratio = m[r.part] / m[r.whole]
        bad, good = (ratio >= r.bad, ratio <= r.good) if r.bad > r.good else (ratio <= r.bad, ratio >= r.good)
        out.append(-1 if bad else 1 if good else 0)
    return tuple(out)


def expected(docs):
    """Rows (doc_id, text, lang, source) after the first four stages."""
    histogram = defaultdict(int)
    for d in docs:
        if test_quality.plain(d[1])[0]:
            histogram[votes(d[1])] += 1
    kept, _ = test_quality.plain_verdict(histogram)
    good = []
    for d in docs:
        n, _, _, _, repeated = test_quality.plain(d[1])[:5]
        if n >= 50 and 100 * repeated <= 50 * n and kept[votes(d[1])]:
            good.append(d)
    classes = dict(zip((d[0] for d in good), (c for _, c in test_near_dedup.classes([d[:2] for d in good]))))
    clean = []
    for d in good:
        if classes[d[0]] == d[0]:
            out, at = "", 0
            for start, end, kind in test_secrets.spans(d[1]):
                if start >= at:
                    out += d[1][at:start] + f"[{kind.upper()}]"
                at = max(at, end)
            clean.append((d[0], out + d[1][at:], *d[2:]))
    return good, clean, mixed(clean)


def mixed(docs):
    def leaf(d):
        number = re.search(r"([0-9]{1,9})$", d[3])
        return (queries.DOMAINS[int(number[1]) % 4] if number else "other", d[2], d[3])

    tokens = {d[0]: test_quality.plain(d[1])[0] for d in docs}
    supply = defaultdict(int)
    for d in docs:
        supply[leaf(d)] += tokens[d[0]]
    budget = test_mixing.budgets({p: 4 * s for p, s in supply.items()}, queries.MIX_WEIGHTS, sum(supply.values()))
    taken = []
    for path, b in budget.items():
        mine = [d for d in docs if leaf(d) == path]
        taken += [d for d in mine for _ in range(b // supply[path])]
        read, order = 0, test_mixing.hashlib.md5
        epoch = b // supply[path]
        for d in sorted(mine, key=lambda d: (int(order(f"{queries.MIX_SEED}:{epoch}:{d[0]}".encode()).hexdigest()[:15], 16), d[0])):
            if read >= b % supply[path]:
                break
            taken.append(d)
            read += tokens[d[0]]
    return taken


def test_pipeline(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    good, clean, taken = expected([tuple(r) for r in rows])
    assert 0 < len(clean) < len(good) < len(rows)
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = defaultdict(int)
    for d in taken:
        ids = [*tokenizer.encode(d[1], add_special_tokens=False).ids, queries.PACKED_END]
        for a in range(0, len(ids), queries.SEQUENCE):
            part = ids[a : a + queries.SEQUENCE]
            want[d[0], a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    got = pipeline.run(spark, SF).collect()
    found = defaultdict(int)
    for r in got:
        found[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    assert found == want
    filled = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= queries.SEQUENCE and sorted(filled) == list(range(len(filled)))


def test_stages_on_awkward_documents(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, build in pipeline.STAGES[:-1]:
            assert build(spark, docs, SF).columns == docs.columns, name
            build(spark, docs, SF).count()
        assert pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
    assert len(pipeline.STAGES) == 5


def test_columns_of_documents_stay_as_they_are(spark, prose):
    """Input columns that are named like the operators' own keep their values."""
    names = ["kept", "posterior", "base_failed", "secrets", "row", "of", "doc", "_of", "_row", "_domain", "tokens", "_n", "_document", "epoch"]
    rows = [(i, prose(i, 80) + f" token=abcdefghijkl{i}.", "en", "src1", 5) + tuple(f"{c}{i}" for c in names) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame(rows, schema)
    for name, build in pipeline.STAGES[:-1]:
        got = build(spark, docs, SF)
        assert got.columns == docs.columns
        out = got.collect()
        assert out, name
        for r in out:
            assert [r[c] for c in names] == [f"{c}{r['doc_id']}" for c in names], name


def test_weights_name_nodes_of_the_tree():
    assert all(1 <= len(p) <= len(queries.MIX_LEVELS) and w >= 0 for p, w in queries.MIX_WEIGHTS.items())
