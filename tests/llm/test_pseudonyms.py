"""Pseudonyms: permutations within a format, the same everywhere, of valid values only."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from carelake.llm import pseudonyms as op

KEY = "k"


def rewrite(spark, texts, key=KEY):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in op.pseudonymise(df, key).collect()}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def card(n, length=16):
    body = "4" + str(n).zfill(length - 2)
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


@pytest.mark.parametrize("a, b", [(10, 10), (10, 100), (189, 773)])
def test_feistel_is_a_permutation(spark, a, b):
    n = spark.range(a * b)
    pair = op.feistel(KEY, "x", F.floor(F.col("id") / b), F.col("id") % b, F.lit(a).cast("long"), F.lit(b).cast("long"))
    got = [r[0] for r in n.select(pair.alias("p")).select(F.expr(f"p.a * {b} + p.b")).collect()]
    assert sorted(got) == list(range(a * b))
    assert sum(i == g for i, g in enumerate(got)) < 12


def test_digits_are_permuted(spark):
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(1000)], "s string")
    got = [r[0] for r in df.select(op.permute_digits(KEY, "x", F.col("s"))).collect()]
    assert sorted(got) == [f"{i:03d}" for i in range(1000)]


def test_formats_are_kept(spark):
    cards = [card(i * 7919) for i in range(50)] + [card(i, 13) for i in range(10)] + [card(i, 19) for i in range(10)]
    texts = [f"pay {c} now" for c in cards]
    got = rewrite(spark, texts)
    out = [got[i]["text"][4:-4] for i in range(len(texts))]
    assert all(luhn(o) and len(o) == len(c) and o != c for o, c in zip(out, cards))
    assert len(set(out)) == len(cards)
    assert all(o[:4] == c[:4] for o, c in zip(out, cards))

    texts = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "+1 (017) 555-7713", "(017) 555-7713",
             "017-555-7713", "10.0.0.255", "2020-02-29", "29/02/2020", "29.02.2020", "2/29/2020"]
    got = [rewrite(spark, [t])[0] for t in texts]
    shape = lambda s: re.sub(r"\d", "9", s)
    for t, r in zip(texts, got):
        assert len(r["pii"]) == 1 and r["text"] != t
        if r["pii"] in (["card"], ["phone"]):
            assert shape(r["text"]) == shape(t)
    digits = lambda r: re.sub(r"\D", "", r["text"])
    assert digits(got[0]) == digits(got[1]) == digits(got[2])  # one number, however it is written
    assert got[3]["text"].startswith("+1 (") and digits(got[3])[1:] == digits(got[4]) == digits(got[5])
    assert all(0 <= int(p) <= 255 for p in got[6]["text"].split("."))
    day = datetime.date.fromisoformat(got[7]["text"])
    assert got[8]["text"] == day.strftime("%d/%m/%Y") == got[10]["text"] and got[9]["text"] == day.strftime("%d.%m.%Y")


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "256.1.1.1", "1.2.3.4.5", "2021-13-01", "2021-02-30", "31/04/2020 x", "1799-12-31", "2200-01-01",
             "v1.2.3", "12345", "a@b", "@b.co", "x@a..b.com", "x@.b.com", "7536784127813050", "123456789012345678901", "0x4111111111111111", "room 555-7713", "2020-02-291"]
    for i, r in rewrite(spark, texts).items():
        assert r["text"] == texts[i] and r["pii"] == [], texts[i]


def test_links_and_keys(spark, prose):
    value = "und.34@mail7.example.com"
    got = rewrite(spark, [f"{prose(1, 9)} {value}, x", f"{value.upper()}!", value])
    names = [re.search(r"u[0-9a-f]{20}@example\.invalid", r["text"])[0] for r in got.values()]
    assert len(set(names)) == 1
    c = card(5)
    assert rewrite(spark, [c], "k1")[0]["text"] != rewrite(spark, [c], "k2")[0]["text"]


def test_several_in_one_text(spark):
    text = f"é {card(1)}, 1.2.3.4 and {card(1)}\n(017) 555-7713\U0001f600 end 2"
    r = rewrite(spark, [text])[0]
    assert r["pii"] == ["card", "ip", "card", "phone"]
    parts = re.fullmatch(r"é (\d{16}), ([\d.]+) and (\d{16})\n(\(\d{3}\) \d{3}-\d{4})\U0001f600 end 2", r["text"])
    assert parts and parts[1] == parts[3] != card(1)


def test_cards_beside_other_numbers(spark):
    visa, amex, long_ = "4111 1111 1111 1111", "3782 822463 10005", card(7, 19)
    loose = "411111 11111 11111"
    cards = [visa, visa.replace(" ", ""), amex, long_, loose]
    alone = {cards[i]: r["text"] for i, r in rewrite(spark, cards).items()}
    around = [("", " 123"), ("", " 12/27"), ("5 ", ""), ("5 ", " 123"), ("2027 ", " 2"), ("", " 12/27 123"), ("1 2 3 ", " 4 5 6"), ("", ", 7 ")]
    cases = [(before, c, after) for before, after in around for c in cards[:4]]
    for i, r in rewrite(spark, ["".join(case) for case in cases]).items():
        before, c, after = cases[i]
        assert (r["text"], r["pii"]) == (before + alone[c] + after, ["card"]), cases[i]
    # By any chance of the check digit, whatever follows.
    texts = [f"{visa} {i}" for i in range(100, 200)]
    assert [r["text"] for r in rewrite(spark, texts).values()] == [f"{alone[visa]} {i}" for i in range(100, 200)]
    assert alone[loose] != loose


def test_numbers_that_are_no_cards_stay(spark):
    rng = random.Random(3)
    single = [" ".join(rng.choices("0123456789", k=16)) for _ in range(150)]
    tables = [" ".join(str(rng.randrange(1000, 10_000)) for _ in range(40)) for _ in range(150)]
    stamps = [str(1_700_000_000_000 + rng.randrange(10**10)) for _ in range(200)]
    others = [o for o in ("".join(rng.choices("0178", k=1) + rng.choices("0123456789", k=15)) for _ in range(200))]
    lists = [" ".join(str(rng.randrange(10**5)) for _ in range(12)) for _ in range(100)]
    texts = single + tables + stamps + others + lists
    assert [r["text"] for r in rewrite(spark, texts).values()] == texts
    two = "4111 1111 1111 1111 5500 0000 0000 0004"
    assert rewrite(spark, [two])[0]["pii"] == ["card", "card"]


@pytest.mark.parametrize("unit", ["4", "1 ", "12 ", "4111 ", "4111", "a", "a.", "x@a.", "@", "1.", "1.1.1.1 ", "+1 ", "(0", "2020-01-", "1/1/", "0 ", "-", "a@b.co ", "\ufdd3"])
def test_long_texts_of_one_unit(spark, unit):
    """Neither the stack nor the square of the length is used up: two lengths, up to a megabyte."""
    for size in (8_000, 1_000_000):
        text = "x@" + unit * (size // len(unit)) + "com"
        assert len(rewrite(spark, [text])[0]["text"]) > 0


def test_all_of_a_row_of_numbers(spark):
    r = rewrite(spark, ["9807915762804490 190.137.223.204"])[0]
    assert r["pii"] == ["ip"] and "190.137.223.204" not in r["text"]
    text = f"{card(3)} 190.137.223.204 {card(4)} 2020-02-29 {card(5)} {card(6)} 017-555-7713 29/02/2020 x@example.com {card(7)}"
    r = rewrite(spark, [text])[0]
    assert r["pii"] == ["card", "ip", "card", "date", "card", "card", "phone", "date", "email", "card"]
    assert not set(text.split()) & set(r["text"].split())
    assert rewrite(spark, [f"{card(3)}@example.com"])[0]["pii"] == ["email"]
    odd = "\ufdd3\ufdde\ufddf $1 \\ "
    r = rewrite(spark, [odd + card(3) + odd])[0]
    assert r["pii"] == ["card"] and r["text"] == odd + rewrite(spark, [card(3)])[0]["text"] + odd


def test_phones_of_other_countries(spark):
    phones = ["+49 30 12345678", "+33 1 23 45 67 89", "01 23 45 67 89", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+34 912 34 56 78",
              "(030) 12345678", "030/12345678", "020 7946 0958", "01.23.45.67.89", "0171 2345678", "+4930 1234 5678"]
    got = rewrite(spark, [f"call {p}, or 5" for p in phones] + ["+331234567", "0123456789", "01 23 45", "0.25 0.75 0.5"])
    for i, p in enumerate(phones):
        new = got[i]["text"][5:-6]
        assert got[i]["pii"] == ["phone"] and new != p and re.sub(r"\d", "9", new) == re.sub(r"\d", "9", p), p
        assert got[i]["text"] == f"call {new}, or 5"
    assert [got[i]["pii"] for i in range(len(phones), len(got))] == [[]] * 4
    digits = [re.sub(r"\D", "", got[i]["text"][5:-6]) for i in range(len(phones))]
    assert digits[0] == digits[11]  # one number, however it is grouped


def test_awkward_documents(awkward, nothing):
    got = op.pseudonymise(awkward, KEY)
    before = sorted(((r["doc_id"], r["text"]) for r in awkward.collect()), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == before
    assert op.pseudonymise(nothing, KEY).count() == 0
