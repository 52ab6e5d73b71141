"""Packing documents into training sequences by cutting-stock patterns.

A document's ids are cut into pieces of the sequence length and a rest. The rests make a
histogram of at most ``length / grain`` size classes, sizes rounded up to the grain; that is
all the driver sees. ``cutting_stock`` finds the patterns of classes that fill sequences; each
pattern takes the next pieces of its classes, ranked by document, so a join on a table of rank
intervals, which has a bounded number of rows, tells every piece its sequence.

Defined results: NULL text is the empty text, which still has its end id; NULL doc_ids come
first; repeated rows are packed each; an empty table gives no pieces; columns but doc_id and
text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import small_batches
from carelake.llm.cutting_stock import patterns
from carelake.operators.ordering import ordered_scan
from carelake.session import stage

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
WITH_IDS = f"{PIECES}, width int, ids binary"


def cut(docs: DataFrame, tokenizer: str, *, length: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs(doc_id, text)``: whole sequences, and one rest of each document.

    ``ids_crc32`` is of a piece's ids at 4 bytes each. With ``with_ids``, which ``sequences`` needs
    and ``pack`` does not, ``ids`` holds them as little-endian integers of ``width`` bytes.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.tokens import encoder

        own = encoder(tokenizer)
        for batch in batches:
            for first, ids, ends in own.parts(batch.column(1), end_id):
                many = np.diff(ends, prepend=0)
                of = np.repeat(np.arange(len(many)), -(-many // length))
                each = np.bincount(of, minlength=len(many))
                start = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * length
                size = np.minimum(length, many[of] - start)
                at = (ends - many)[of] + start
                wide = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(wide[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(first + of)), *map(pa.array, (start, size, np.array(crc, dtype=np.int64), many[of]))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    raw = [ids[a : a + n].tobytes() for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                    columns += [pa.array(np.full(len(of), ids.itemsize, dtype=np.int32)), pa.array(raw, pa.binary())]
                    names += ["width", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    small_batches(docs.sparkSession, 2048)
    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(pieces, WITH_IDS if with_ids else PIECES)


def _intervals(demand: dict[int, int], capacity: int, alone: int) -> list[tuple]:
    """``size, from, to, each, base``: the pieces of a class with ranks from ``from`` to before
    ``to`` go, ``each`` together, to the sequences from ``base`` on; and the ``place`` that the
    class has in the pattern. The ``alone`` pieces of class 0 get a sequence each."""
    rows, next_rank, base = [], dict.fromkeys(demand, 0), 0
    for pattern, times in patterns(demand, capacity):
        for place, (size, each) in enumerate(pattern):
            start = next_rank[size]
            next_rank[size] = start + each * times
            rows.append((size, start, next_rank[size], each, base, place))
        base += times
    return [*rows, (0, 0, alone, 1, base, 0)]


def pack(pieces: DataFrame, *, length: int, grain: int = 8) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id``, gapless from 0, and ``offset`` within it.

    Rounding sizes up to ``grain`` leaves half of it per piece unused on average; a finer grain
    makes a larger linear program, not more data.
    """
    spark, capacity = pieces.sparkSession, length // grain
    # Where the grain does not divide the length, the longest pieces fit no class.
    size = F.ceil(F.col("length") / grain).cast("int")
    fits = F.when(F.col("length") > capacity * grain, F.lit(0)).otherwise(size)
    narrow = pieces.select(
        *[c for c in pieces.columns if c not in ("ids", "sequence_id", "offset")],
        fits.alias("_size"),
        F.lit(1).alias("_one"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ranked = stage(
        ordered_scan(narrow, keys=["_size"], order=["doc_id", "start", "_row"], sums={"_rank": "_one"}),
        "ranked-pieces",
    )
    demand = {r["_size"]: r["count"] for r in ranked.groupBy("_size").count().collect()}
    alone = demand.pop(0, 0)
    table = spark.createDataFrame(
        _intervals(demand, capacity, alone),
        "_of int, _from long, _to long, _each long, _base long, _place int",
    )
    within = (
        (F.col("_size") == F.col("_of")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    )
    nth = F.col("_rank") - F.col("_from")
    placed = ranked.join(F.broadcast(table), within).withColumn(
        "sequence_id", F.col("_base") + F.floor(nth / F.col("_each"))
    )
    order = Window.partitionBy("sequence_id").orderBy("_place", "_rank")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(before, F.lit(0))).drop(
        "_size", "_one", "_rank", "_of", "_from", "_to", "_each", "_base", "_place"
    )


def sequences(pieces: DataFrame, packed: DataFrame, *, length: int, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces``: the ids of each sequence, padded, and which piece
    lies where. ``pieces`` were cut with their ids. A sequence has at most ``length`` pieces."""
    key = ["doc_id", "start", "length", "ids_crc32"]
    numbered = Window.partitionBy(*key).orderBy(F.lit(1))
    with_ids = pieces.select(*key, "width", "ids", F.row_number().over(numbered).alias("_copy"))
    placed = packed.select(*key, "sequence_id", "offset", F.row_number().over(numbered).alias("_copy"))
    same = [placed[c].eqNullSafe(with_ids[c]) for c in [*key, "_copy"]]
    joined = placed.join(with_ids, same).select(
        "sequence_id", "width", placed["length"],
        F.struct("offset", placed["doc_id"], placed["start"], placed["length"], "ids").alias("piece"),
    )
    ordered = F.sort_array(F.collect_list("piece"))
    grouped = joined.groupBy("sequence_id").agg(
        F.max("width").alias("width"), F.sum("length").alias("n_tokens"), ordered.alias("_all")
    )
    ids = F.aggregate("_all", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    pad = F.when(F.col("width") == 2, F.lit(pad_id.to_bytes(2, "little"))).otherwise(
        F.lit(pad_id.to_bytes(4, "little"))
    )
    padded = F.call_function("rpad", ids, (F.lit(length) * F.col("width")).cast("int"), pad)
    return grouped.select(
        "sequence_id",
        "n_tokens",
        "width",
        padded.alias("ids"),
        F.transform("_all", lambda p: p.dropFields("ids")).alias("pieces"),
    )
