"""Ranked lexical search: documents by the impacts of an item's terms, over K2-treaps.

A pass over the documents counts, per document, all terms and those that items ask for. From
these counts come the statistics of the corpus. Then each task goes through its documents in
ranges: a range's postings make one K2-treap per block of items, in which the paths of an item's
terms descend together, and an item's bar, the worst of its best so far, goes on from range to
range. A task gives ``k`` rows per item, and the best of those are kept.

Items are taken in waves: the distinct terms of one wave, on average ``WAVE_TERMS`` at most, are
held by each task. Within a wave, a block of items has about ``BLOCK_TERMS`` distinct terms, the
rows of a grid; a range has ``RANGE_DOCS`` documents or ``RANGE_CELLS`` postings at most.

Defined results: texts without terms, NULL among them, are no documents, and items without any
have no rows; repeated rows are documents, and items, of their own; of equal scores the smaller
doc_id comes first and NULL last; only scores above 0 count; without documents there are no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import small_batches
from carelake.session import stage

WAVE_TERMS, BLOCK_TERMS = 200_000, 2_048
RANGE_DOCS, RANGE_CELLS = 1 << 15, 1 << 19

# Letters and digits of ASCII, and all beyond it, make terms; all else parts them.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in (c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def wanted_terms(items: DataFrame) -> DataFrame:
    """``no, item_id, terms``: the distinct terms of each row of ``items(item_id, text)``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.lexical import terms

        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = pa.array([sorted(set(terms(t or b""))) for t in texts], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["no", "item_id", "terms"])

    small_batches(items.sparkSession)
    rows = items.select(F.monotonically_increasing_id().alias("no"), items["item_id"].cast("long"), items["text"])
    return rows.mapInArrow(of_batches, "no long, item_id long, terms array<binary>")


def count_terms(docs: DataFrame, sought: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, of, tf``: per document with terms, how many it has, and the numbers and counts
    of those that are sought."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        from carelake.llm.lexical import terms

        for batch in batches:
            rows, n, of, tf, sizes = [], [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms(text or b"")
                if not found:
                    continue
                counts = Counter(map(sought.get, found))
                counts.pop(None, None)
                rows.append(i)
                n.append(len(found))
                of += counts.keys()
                tf += counts.values()
                sizes.append(len(counts))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(of, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64())),
                ],
                names=["doc_id", "n", "of", "tf"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return rows.mapInArrow(of_batches, "doc_id long, n long, of array<int>, tf array<long>")


# --- Scores -------------------------------------------------------------------------


@dataclass(frozen=True)
class Scoring:
    """Terms in a thousandth of their information, and a saturating share of their count that
    falls with a document's length; whole numbers of 64 bits but for the logarithm."""

    documents: int
    all_terms: int
    norm: int = 90
    length_weight: int = 8

    def weight(self, df: np.ndarray) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)

    def share(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - self.norm + (self.norm * n * self.documents) // max(self.all_terms, 1)
        return (1_000_000_000 * tf) // (1000 * tf + self.length_weight * m)


@dataclass
class Block:
    """Items with the rows of their terms. ``terms`` are those of the rows, of like weights side by
    side, and ``weight`` theirs."""

    terms: np.ndarray
    weight: np.ndarray
    items: list[tuple[int, np.ndarray]]

    def row_of_term(self, all_terms: int) -> np.ndarray:
        """The row of each term of the wave, or -1."""
        row = np.full(all_terms, -1, dtype=np.int64)
        row[self.terms] = np.arange(len(self.terms))
        return row


def blocks(items: list[tuple[int, np.ndarray]], weight: np.ndarray, most: int) -> list[Block]:
    """``items`` are numbers and the terms of each. A block is closed when it has ``most`` terms."""
    out: list[Block] = []
    own: list[tuple[int, np.ndarray]] = []
    held: set[int] = set()
    for i, (no, of) in enumerate(items):
        own.append((no, of))
        held.update(of.tolist())
        if len(held) < most and i + 1 < len(items):
            continue
        rows = np.array(sorted(held, key=lambda t: (-weight[t], t)), dtype=np.int64)
        block = Block(rows, weight[rows], [])
        row = block.row_of_term(len(weight))
        block.items.extend((n, row[o]) for n, o in own)
        out.append(block)
        own, held = [], set()
    return out


def search_ranges(
    batches: Iterator[pa.RecordBatch], parts: list[Block], all_terms: int, scoring: Scoring, k: int
) -> Iterator[pa.RecordBatch]:
    """``no, doc_id, score``: the best of one task, from batches of ``count_terms``."""
    from carelake.llm.k2_treap import Best, Treap

    best = {no: Best(k) for part in parts for no, _ in part.items}

    def search(held: list[pa.RecordBatch]) -> None:
        ids = np.concatenate([b.column(0).fill_null(0).to_numpy() for b in held])
        known = np.concatenate([b.column(0).is_valid().to_numpy(zero_copy_only=False) for b in held])
        n = np.concatenate([b.column(1).to_numpy() for b in held])
        many = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held])
        of, tf = (np.concatenate([b.column(i).flatten().to_numpy() for b in held]) for i in (2, 3))
        column = np.repeat(np.arange(len(ids)), many)
        share = scoring.share(tf, n[column])
        for part in parts:
            row = part.row_of_term(all_terms)[of]
            impact = part.weight[row] * share
            here = (row >= 0) & (impact > 0)
            treap = Treap(row[here], column[here], impact[here], (len(part.weight), len(ids)))
            for no, rows in part.items:
                treap.top(rows, best[no].grid(ids, known))

    held, docs, cells = [], 0, 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        docs, cells = docs + len(batch), cells + len(batch.column(2).flatten())
        if docs >= RANGE_DOCS or cells >= RANGE_CELLS:
            search(held)
            held, docs, cells = [], 0, 0
    if held:
        search(held)
    for no, found in best.items():
        ids = pa.array(found.of, pa.int64(), mask=~found.named)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), no, dtype=np.int64)), ids, pa.array(found.scores)], names=["no", "doc_id", "score"]
        )


def _wave(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """``no, doc_id, score`` of the items of one wave. The wave's terms and their numbers of
    documents come to the driver; they are bounded, whatever the documents."""
    held = [(r["no"], [bytes(t) for t in r["terms"]]) for r in items.collect()]
    number = {t: i for i, t in enumerate(sorted({t for _, ts in held for t in ts}))}
    counted = stage(count_terms(docs, number), "term-counts")
    total = counted.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    scoring = Scoring(total["n"], total["all"])
    df = np.zeros(len(number), dtype=np.int64)
    for r in counted.select(F.explode("of").alias("of")).groupBy("of").count().collect():
        df[r["of"]] = r["count"]
    numbered = [(no, np.array([number[t] for t in ts], dtype=np.int64)) for no, ts in sorted(held)]
    parts, all_terms = blocks(numbered, scoring.weight(df), BLOCK_TERMS), len(number)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.lexical import search_ranges

        return search_ranges(batches, parts, all_terms, scoring, k)

    return counted.mapInArrow(search, "no long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 10, wave_terms: int = WAVE_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` over ``docs(doc_id, text)`` and ``items(item_id, text)``."""
    wanted = stage(wanted_terms(items).filter(F.size("terms") > 0), "items")
    waves = max(1, math.ceil((wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) / wave_terms))
    found = None
    for wave in range(waves):
        own = wanted.filter(F.pmod(F.xxhash64("no"), F.lit(waves)) == wave)
        one = stage(_wave(docs, own, k), "found")
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = wanted.select(F.col("no").alias("_no"), "item_id")
    return ranked.join(names, F.col("no") == F.col("_no")).select("item_id", "rank", "doc_id", "score")
