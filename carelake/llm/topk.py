"""Exact top-k search: a set of queries against all vectors, by inner product.

Queries and vectors are dealt by hash into blocks of a bounded number of rows, and every block
of queries meets every block of vectors in one task, where two cover trees are walked together.
A task gives k rows per query of its block, whatever the vectors, and the best k of those are
kept. What a task holds is bounded by the two block sizes.

Defined results: rows whose id or vector is NULL, or whose vector holds NULL or non-finite
components, take no part; of rows with equal id each is a query and a candidate of its own, told
apart by ``query_row`` in the result; vectors of unequal length are filled up with zeros; of equal
scores the smaller id comes first; a query with fewer than k others gets all of them; without queries or vectors there are no rows.
Components are held within 64 bits, and so are scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import stage


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double; NULL unless all components are finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))
    return F.when(F.coalesce(finite, F.lit(False)), scaled)


def _matrix(vectors: pd.Series) -> np.ndarray:
    widest = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), max(widest, 1)), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _search(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    from carelake.llm.cover_tree import build, top_k

    if not len(queries) or not len(data):
        return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []}, dtype="int64")
    q, x = _matrix(queries["vector"]), _matrix(data["vector"])
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    tree = build(queries["vec_id"].to_numpy(), q, queries["row"].to_numpy())
    best, _ = top_k(tree, build(data["vec_id"].to_numpy(), x, data["row"].to_numpy()), k)
    row, place = np.nonzero(best.taken)
    return pd.DataFrame(
        {"query_id": tree.ids[row], "query_row": tree.rows[row], "vec_id": best.ids[row, place], "score": best.scores[row, place]}
    )


def search(
    vectors: DataFrame, is_query: Column, *, k: int, query_block: int = 4096, data_block: int = 4096
) -> DataFrame:
    """``query_id, rank, vec_id, score, query_row`` over ``vectors(vec_id, vector)`` of whole numbers, with
    the rows for which ``is_query`` holds as queries. Blocks have about that many rows."""
    rows = vectors.filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = stage(rows.select("vec_id", "vector", F.monotonically_increasing_id().alias("row")), "vectors")
    queries = rows.filter(is_query)
    blocks = {
        name: max(1, math.ceil(df.count() / size))
        for name, df, size in (("q", queries, query_block), ("x", rows, data_block))
    }

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(blocks[own])).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit(blocks[other] - 1)))
        return df.select("vec_id", "vector", "row", block.alias(own), others.alias(other)).groupBy("q", "x")

    def search_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search(left, right, k)

    found = dealt(queries, "q", "x").cogroup(dealt(rows, "x", "q")).applyInPandas(
        search_block, "query_id long, query_row long, vec_id long, score long"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_row")
