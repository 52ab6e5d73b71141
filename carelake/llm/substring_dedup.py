"""Removal of passages that occur more than once, by super-k-mer partitioning.

1. Every text is cut into super-k-mers, of which only minimiser and place are kept.
2. Minimisers that occur once cannot be those of an equal pair of windows. What remains are
   candidates; only their words travel on, a super-k-mer as one packed string.
3. Packed strings gather by minimiser. In a bucket, the windows are sorted as strings and equal
   neighbours counted: this is exact, hashes decide nothing.
4. A minimiser that more than ``HOT_ROWS`` super-k-mers have would be too much for one task. Its
   packed strings are counted by their whole content instead, combined before the shuffle:
   where one occurs twice, all its windows do. Strings that occur once are taken apart into
   windows, which spread by their content.
5. The windows found, as places in documents, are joined to the texts.

The texts are shuffled once; the joins on them share that exchange.

Defined results: NULL and empty texts have no words; rows are told apart by doc_id and a hash of
the text, and repeated rows are passages of each other; NULL doc_ids are one value; an empty
table gives no rows; columns but doc_id and text are not read. Long texts are cut whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import small_batches
from carelake.session import stage

MINIMISER_WORDS = 5
HOT_ROWS = 1_000
SALTS = 16
_KEY = "doc_id long, h long"
_PACKED = f"{_KEY}, minimiser long, start int, n int, packed string"
_FOUND = f"{_KEY}, start int, n int"


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["_doc"]) & (left["h"] == right["_h"])


def _by_row(rows: DataFrame, collected: Column) -> DataFrame:
    return rows.groupBy(F.col("doc_id").alias("_doc"), F.col("h").alias("_h")).agg(collected)


def find_superkmers(rows: DataFrame, k: int) -> DataFrame:
    """``doc_id, h, minimiser, start, n`` of ``rows(doc_id, h, text)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.superkmers import superkmers

        for batch in batches:
            for index, minimiser, start, n in superkmers(batch.column(2), k, MINIMISER_WORDS):
                owner = pa.array(index)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owner),
                        batch.column(1).take(owner),
                        pa.array(minimiser),
                        pa.array(start, pa.int32(), safe=True) if len(start) else pa.array([], pa.int32()),
                        pa.array(n, pa.int32(), safe=True) if len(n) else pa.array([], pa.int32()),
                    ],
                    names=["doc_id", "h", "minimiser", "start", "n"],
                )

    return rows.mapInArrow(cut, f"{_KEY}, minimiser long, start int, n int")


def _packed(with_spans: DataFrame, k: int, hot: bool) -> DataFrame:
    """The candidates of hot minimisers, or of the others, each with its words as one string."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.substring_dedup import packed_rows

        for batch in batches:
            yield packed_rows(batch, k, hot)

    return with_spans.mapInArrow(pack, _PACKED)


def packed_rows(batch: pa.RecordBatch, k: int, hot: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(6)]
    rows = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True)
    for row, (doc_id, h, spans) in enumerate(rows):
        spans = [s for s in spans if s["hot"] == hot]
        if not spans:
            continue
        words = batch.column(2)[row].as_py().encode().split()
        for s in spans:
            text = b" ".join(words[s["start"] : s["start"] + s["n"] + k - 1])
            for column, value in zip(columns, (doc_id, h, s["minimiser"], s["start"], s["n"], text), strict=True):
                column.append(value)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(columns[5], pa.binary()).cast(pa.string())],
        names=[x.split()[0] for x in _PACKED.split(", ")],
    )


def repeated_in_bucket(packed: list[bytes], k: int) -> list[list[int]]:
    """Per packed string, which of its windows occur in the bucket more than once. The windows of
    all strings are sorted; equal ones are neighbours."""
    copies: dict[bytes, list[int]] = {}
    for i, text in enumerate(packed):
        copies.setdefault(text, []).append(i)
    windows = []
    for own in copies.values():
        text, at = packed[own[0]], [0]
        for word in text.split(b" "):
            at.append(at[-1] + len(word) + 1)
        windows += [(text[at[j] : at[j + k] - 1], own[0], j) for j in range(len(at) - k)]
    found: dict[int, list[int]] = {own[0]: [] for own in copies.values()}
    if len(copies) > 1:
        windows.sort()
    for i, (text, row, j) in enumerate(windows):
        if (
            len(copies[packed[row]]) > 1
            or (i > 0 and windows[i - 1][0] == text)
            or (i + 1 < len(windows) and windows[i + 1][0] == text)
        ):
            found[row].append(j)
    return [sorted(found[copies[text][0]]) for text in packed]


def runs(places: list[int]) -> Iterator[tuple[int, int]]:
    """Ascending places as (first, how many) of neighbours."""
    first = last = None
    for p in places:
        if first is not None and p == last + 1:
            last = p
            continue
        if first is not None:
            yield first, last - first + 1
        first = last = p
    if first is not None:
        yield first, last - first + 1


def _in_buckets(packed: DataFrame, k: int) -> DataFrame:
    """Windows that are repeated within their bucket, as runs of places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.substring_dedup import repeated_in_bucket, runs

        def settle(rows: list[tuple], out: list[tuple]) -> None:
            if len(rows) < 2:
                return
            for row, places in zip(rows, repeated_in_bucket([r[4] for r in rows], k), strict=True):
                out += [(row[0], row[1], row[3] + first, n) for first, n in runs(places)]

        bucket, own = [], None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            texts = batch.column(5).cast(pa.binary()).to_pylist()
            for row in zip(*columns, texts, strict=True):
                if row[2] != own:
                    settle(bucket, out)
                    bucket, own = [], row[2]
                bucket.append(row)
            yield _spans(out)
        last: list[tuple] = []
        settle(bucket, last)
        yield _spans(last)

    return packed.repartition("minimiser").sortWithinPartitions("minimiser").mapInArrow(count, _FOUND)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h", "start", "n"])


def _of_hot(packed: DataFrame, k: int) -> DataFrame:
    """The same for hot minimisers, by counts of whole strings and then of single windows.

    One string, or one window, may still be that of a third of all rows. Counting combines it
    before the shuffle; to find its rows again, these are dealt by a salt as well, and each of
    the few counted ones is given to every salt.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    strings = packed.groupBy("minimiser", "packed").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "h", "start")).alias("at"), F.min("n").alias("n")
    )
    many = strings.filter("c > 1").select(
        F.col("minimiser").alias("_m"), F.col("packed").alias("_p"), salts.alias("_s")
    )
    salted = packed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "h", "start"), F.lit(SALTS)).cast("int"))
    same = (F.col("minimiser") == F.col("_m")) & (F.col("packed") == F.col("_p")) & (F.col("salt") == F.col("_s"))
    whole = salted.join(many, same).select("doc_id", "h", "start", "n")

    words = F.split("packed", " ", -1)
    windows = strings.select("c", "at", words.alias("w"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    windows = windows.select(
        "c", "at", "j", F.array_join(F.slice("w", F.col("j") + 1, k), " ").alias("window")
    )
    again = windows.groupBy("window").agg(F.sum("c").alias("n")).filter("n > 1")
    again = again.select(F.col("window").alias("_w"), salts.alias("_s"))
    alone = windows.filter("c = 1").withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("int"))
    alone = alone.join(again, (F.col("window") == F.col("_w")) & (F.col("salt") == F.col("_s")))
    return whole.unionByName(
        alone.select("at.doc_id", "at.h", (F.col("at.start") + F.col("j")).alias("start"), F.lit(1).alias("n"))
    )


def remove_repeats(docs: DataFrame, *, k: int) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words of each text that no repeated window of
    ``k`` words covers, joined by single spaces. All copies go, the first one too."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]).alias("h"), docs["text"])
    cut = stage(find_superkmers(rows, k), "superkmers")
    shared = cut.groupBy("minimiser").agg(F.count("*").alias("c")).filter("c > 1")
    shared = stage(
        shared.select(F.col("minimiser").alias("_m"), (F.col("c") > HOT_ROWS).alias("hot")), "shared-minimisers"
    )
    candidates = cut.join(shared, F.col("minimiser") == F.col("_m")).select(
        "doc_id", "h", F.struct("start", "n", "minimiser", "hot").alias("span")
    )
    spans = stage(_by_row(candidates, F.collect_set("span").alias("spans")), "candidates")

    with_spans = rows.join(spans, _same_row(rows, spans)).select("doc_id", "h", "text", "spans")
    found = _in_buckets(_packed(with_spans, k, hot=False), k)
    if not shared.filter("hot").isEmpty():
        found = found.unionByName(_of_hot(_packed(with_spans, k, hot=True), k))
    places = _by_row(found, F.collect_set(F.struct("start", "n")).alias("places"))
    return rows.join(places, _same_row(rows, places), "left").select("doc_id", "text", "places").mapInArrow(
        lambda batches: _kept(batches, k), "doc_id long, n_words long, n_removed long, kept string"
    )


def _kept(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for row in range(batch.num_rows):
            words = (batch.column(1)[row].as_py() or "").encode().split()
            n_words.append(len(words))
            places = batch.column(2)[row].as_py()
            if places:
                covered = bytearray(len(words))
                for p in places:
                    stop = p["start"] + p["n"] + k - 1
                    covered[p["start"] : stop] = b"\x01" * (stop - p["start"])
                words = [w for w, gone in zip(words, covered, strict=True) if not gone]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )
