"""Token ids, records and packing against whole-text encoding and plain reading."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from carelake.llm import cutting_stock, packing, queries, records
from carelake.llm.tokens import WordEncoder
from carelake.session import new_path, stage

VOCABULARY = queries.tokenizer_file()


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text, end: [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_words_give_what_whole_texts_give(whole):
    rng = random.Random(0)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()] + ["​", "᠎", "﻿"]
    odd = ["don't", "it's.", "'s", "A.B,c", "12ab", "İ", "ǅo", "é", "́", "naïve!", "ﬁn",
           "<|endoftext|>", "x<|startoftext|>y", "Ång", "z" * 300, "\U0001f600", "中文", "क्ष", "...", "!", "ab!!", "क़", "Ω", "ᄀ", "ᅡ", "ΟΔΟΣ,", "ß?", "a,", "é.", "é"]
    texts = ["", None, *spaces, *odd]
    texts += ["".join(rng.choice(odd + ["word", "Word,"]) + rng.choice(spaces) for _ in range(30)) for _ in range(300)]
    for limit in (10, 10**6):
        encoder = WordEncoder(VOCABULARY, max_words=limit)
        for at in range(0, len(texts), 50):
            got = encoder.ids(texts[at : at + 50], 1)
            assert [np.frombuffer(g, encoder.dtype).tolist() for g in got] == [whole(t, 1) for t in texts[at : at + 50]]


def test_records_round_trip(spark, awkward, texts_of, whole):
    path = new_path(spark, "records")
    records.write_records(awkward, path, VOCABULARY, end_id=2)
    index = records.read_index(spark, path)
    got = records.with_starts(records.read_records(index, path), index).collect()
    ids = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in sorted(got, key=lambda r: r["start"])]
    assert sorted(ids, key=repr) == sorted(((i, whole(t, 2)) for i, t in texts_of), key=repr)
    assert [i is not None for i, _ in ids] == sorted(i is not None for i, _ in ids)
    numbers = [i for i, _ in ids if i is not None]
    assert numbers == sorted(numbers)
    start = 0
    for r in sorted(got, key=lambda r: (r["start"])):
        assert r["start"] == start
        start += len(r["ids"]) // 4
    some = index.filter("doc_id % 2 = 1").orderBy(F.desc("length"))
    assert records.read_records(some, path).count() == sum(1 for i, _ in ids if i is not None and i % 2)


def test_damage_is_seen(spark, awkward, tmp_path):
    path = str(tmp_path / "records")
    records.write_records(awkward.coalesce(1), path, VOCABULARY, end_id=2)
    file = max((tmp_path / "records" / "data").iterdir(), key=lambda f: f.stat().st_size)
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 1
    file.write_bytes(data)
    with pytest.raises(PythonException, match="checksum"):
        records.read_records(records.read_index(spark, path), path).count()


def test_frames():
    framed = records.frame(b"abc") + records.frame(b"")
    assert records.unframe(framed) == b"abc" and records.unframe(framed, len(records.frame(b"abc"))) == b""
    for cut in (0, 5, 13, len(records.frame(b"abc")) - 1):
        with pytest.raises(records.CorruptRecord):
            records.unframe(framed[:cut])


def test_no_records(spark, nothing):
    path = new_path(spark, "records")
    records.write_records(nothing, path, VOCABULARY, end_id=2)
    index = records.read_index(spark, path)
    assert records.with_starts(records.read_records(index, path), index).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_patterns_meet_the_demand(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 40, 64])
    demand = {s: rng.choice([0, 1, 7, 500]) for s in rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 30)))}
    used, met = 0, Counter()
    for pattern, times in cutting_stock.patterns(demand, capacity):
        assert sum(s * n for s, n in pattern) <= capacity and times > 0
        used += times
        met.update({s: n * times for s, n in pattern})
    assert met == Counter({s: n for s, n in demand.items() if n})
    # No packing needs fewer than the volume, nor than the pieces above half the capacity.
    volume = sum(s * n for s, n in demand.items()) / capacity
    large = sum(n for s, n in demand.items() if 2 * s > capacity)
    assert used <= max(volume, large) * 1.25 + len(demand) + 1


def test_patterns_find_the_exact_optimum():
    # 3 + 7 and 4 + 6 fill ten exactly; first-fit by size would not mix them better.
    assert sum(n for _, n in cutting_stock.patterns({3: 100, 7: 100, 4: 50, 6: 50}, 10)) == 150
    assert cutting_stock.patterns({}, 10) == []
    with pytest.raises(ValueError):
        cutting_stock.patterns({11: 1}, 10)


@pytest.mark.parametrize("length, grain", [(64, 8), (50, 8), (2048, 8)])
def test_packing(awkward, texts_of, whole, length, grain):
    pieces = stage(packing.cut(awkward, VOCABULARY, length=length, end_id=1), "pieces")
    packed = packing.pack(pieces, length=length, grain=grain).collect()
    assert not {"ids", "width"} & set(pieces.columns)
    ids = defaultdict(list)
    for i, t in texts_of:
        ids[i].append(whole(t, 1))
    # Each id in one piece: the pieces of a document, put together, are its ids.
    known = {(zlib.crc32(np.array(one[a : a + length], "<u4").tobytes()), i, a, len(one[a : a + length]), len(one))
             for i, copies in ids.items() for one in copies for a in range(0, len(one), length)}
    found = Counter((r["ids_crc32"], r["doc_id"], r["start"], r["length"], r["doc_tokens"]) for r in packed)
    assert set(found) == known
    assert sum(found.values()) == sum(-(-len(one) // length) for copies in ids.values() for one in copies)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    pieces = stage(packing.cut(awkward, VOCABULARY, length=length, end_id=1, with_ids=True), "pieces")
    made = packing.sequences(pieces, packing.pack(pieces, length=length, grain=grain), length=length).collect()
    assert len(made) == len(sequences)
    for r in made:
        assert len(r["ids"]) == length * r["width"]
        assert sum(p["length"] for p in r["pieces"]) == r["n_tokens"]


def test_little_padding(spark, prose):
    docs = spark.createDataFrame([(i, prose(i, 20 + i * 37 % 400)) for i in range(600)], "doc_id long, text string")
    pieces = stage(packing.cut(docs, VOCABULARY, length=256, end_id=1), "pieces")
    total = packing.pack(pieces, length=256).agg(F.sum("length").alias("n"), F.max("sequence_id").alias("s")).first()
    assert total["n"] / ((total["s"] + 1) * 256) > 0.93


def test_nothing_to_pack(nothing):
    pieces = stage(packing.cut(nothing, VOCABULARY, length=64, end_id=1), "pieces")
    assert packing.pack(pieces, length=64).count() == 0
