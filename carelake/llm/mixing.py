"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations alone.

Sources form a tree: domain, language, source, or whatever levels are named. A budget of tokens
flows down it by weight. A child that cannot use its share, because all its documents are too
few even if each is read ``max_epochs`` times, leaves the rest to its siblings; only what a
whole family cannot use goes to the siblings of its parent. Each leaf reads its documents in
epochs, each in a seeded order of its own, and stops at the document that reaches its budget.

All arithmetic is in whole tokens, and the shares of a family add up to its budget.

Defined results: tokens are words; NULL text has none. NULL in a level is a value like any other.
Documents of a leaf without tokens are not taken. Rows of equal doc_id are ordered by a digest of
their text; of rows equal in that too, as many are taken as the budget needs.
An empty table gives an empty plan. A weight of 0 takes a branch out. Other columns pass
through ``select`` unchanged; its own are named with a leading underscore.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import WORD
from carelake.operators.ordering import ordered_scan
from carelake.session import stage

_WIDE = "decimal(38,0)"


def count_tokens(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def _order_key(seed: str, epoch: Column, doc_id: Column) -> Column:
    """The place of a document in an epoch: 60 bits of a digest."""
    name = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _weight(levels: Sequence[str], weights: Mapping[tuple, int]) -> Column:
    """The weight of the node that ``levels`` lead to; 1 where none is given."""
    found = F.lit(1)
    for path, weight in weights.items():
        if len(path) == len(levels):
            same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(levels, path, strict=True)]
            found = F.when(reduce(lambda a, b: a & b, same), F.lit(weight)).otherwise(found)
    return found.cast("long")


def _share(family: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``budget`` of each node from its family's (``given``): the budget is divided by weight
    among those that can use their share; the others get all they can use.

    In the order of capacity per weight, those that cannot come first, and a node is one of
    them if its capacity is no more than its share of what they leave over.
    """
    by_need = Window.partitionBy(*parent).orderBy(
        (F.col("capacity") / F.when(F.col("weight") > 0, F.col("weight"))).asc_nulls_first(), F.col(name).asc_nulls_first()
    )
    until = by_need.rowsBetween(Window.unboundedPreceding, -1)
    on = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    left = F.col("given").cast(_WIDE) - F.coalesce(F.sum(F.col("capacity").cast(_WIDE)).over(until), F.lit(0))
    full = F.col("capacity").cast(_WIDE) * F.sum("weight").over(on) <= left * F.col("weight")
    marked = family.withColumn("full", full)
    shared = marked.withColumns(
        {
            "rest": F.col("given") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole),
            "sharing": F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("weight"))).over(whole),
        }
    ).withColumn(
        "share",
        F.when(F.col("full"), F.col("capacity")).otherwise(
            F.expr(f"(cast(rest as {_WIDE}) * weight) div nullif(sharing, 0)")
        ),
    )
    # What the division leaves over is less than a token for each that shares.
    over = F.col("given") - F.sum("share").over(whole)
    turn = F.row_number().over(Window.partitionBy(*parent, "full").orderBy(F.col(name).asc_nulls_first()))
    extra = F.when(~F.col("full") & (turn <= over), 1).otherwise(0)
    return shared.withColumn("budget", (F.col("share") + extra).cast("long")).drop(
        "full", "rest", "sharing", "share", "given"
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same), how).drop(*[f"_k_{k}" for k in keys])


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple, int], total: int) -> DataFrame:
    """``budget`` for each of ``leaves(*levels, tokens, capacity)``. A total beyond what all can
    use is cut to that."""
    live = reduce(
        lambda a, b: a & b, [_weight(levels[: i + 1], weights) > 0 for i in range(len(levels))]
    )
    leaves = leaves.withColumn("capacity", F.when(live, F.col("capacity")).otherwise(0).cast("long"))
    given = leaves.agg(F.least(F.coalesce(F.sum("capacity"), F.lit(0)), F.lit(total)).cast("long").alias("given"))
    for depth, name in enumerate(levels):
        path, parent = list(levels[: depth + 1]), list(levels[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(path, weights))
        if depth:
            family = _null_safe(nodes, given, parent)
        else:
            family = nodes.withColumn("given", F.lit(given.first()["given"]))
        given = stage(_share(family, parent, name), "budgets").select(*path, F.col("budget").alias("given"))
    return _null_safe(leaves, given.withColumnRenamed("given", "budget"), levels)


def plan(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[tuple, int],
    *,
    total_percent: int = 100,
    max_epochs: int = 4,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """``(counted, leaves)``, both stored: documents as ``doc_id, *levels, tokens, _text``, and leaves as
    ``*levels, leaf_tokens, budget, full_epochs, last, last_rows``: each document of a leaf is taken
    ``full_epochs`` times, and once more if it comes before ``last`` in the epoch after those. Of the
    rows that are ``last``, equal in all that counts, ``last_rows`` are taken. The budget of the tree
    is a percentage of all tokens.
    """
    counted = stage(
        docs.select(
            docs["doc_id"], *[docs[c] for c in levels], count_tokens(docs["text"]).alias("tokens"), _text_hash(docs).alias("_text")
        ),
        "counted",
    )
    sums = stage(counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    all_tokens = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    leaves = budgets(
        sums.withColumn("capacity", F.col("tokens") * max_epochs),
        levels, weights, all_tokens * total_percent // 100,
    ).withColumns(
        {
            "full_epochs": F.expr("coalesce(budget div nullif(tokens, 0), 0)").cast("int"),
            "rest": F.expr("coalesce(budget % nullif(tokens, 0), 0)"),
        }
    )
    leaves = stage(leaves.withColumnRenamed("tokens", "leaf_tokens").drop("capacity"), "leaf-budgets")

    # Each leaf's documents in the order of its last epoch, added up until its rest is reached.
    in_leaf = _null_safe(counted, leaves.filter("rest > 0").drop("budget", "leaf_tokens"), levels)
    keyed = in_leaf.withColumns(
        {"_key": _order_key(seed, F.col("full_epochs"), F.col("doc_id")), "_row": F.monotonically_increasing_id()}
    )
    order = ["_key", "doc_id", "_text", "_row"]
    read = ordered_scan(keyed.drop("full_epochs"), keys=list(levels), order=order, sums={"_before": "tokens"})
    place = F.struct(F.col("_key").alias("k"), F.col("doc_id").alias("d"), F.col("_text").alias("t"))
    ends = read.filter("_before < rest").groupBy(*levels, place.alias("at")).agg(F.count("*").alias("n"))
    last = ends.groupBy(*levels).agg(F.max("at").alias("last"), F.max_by("n", "at").alias("last_rows"))
    return counted, stage(_null_safe(leaves, last, levels, "left"), "mixing-plan")


def _text_hash(docs: DataFrame) -> Column:
    """What tells rows of one doc_id apart; a counted document has it with it."""
    return docs["_text"] if "_text" in docs.columns else F.xxhash64(docs["text"])


def select(docs: DataFrame, leaves: DataFrame, levels: Sequence[str], *, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` that the plan takes, once for each ``_epoch``, in which they are read.
    No document is joined with another one: a row and its leaf decide."""
    columns = [F.col(k) for k in docs.columns]
    plan_ = leaves.select(*levels, "leaf_tokens", "budget", "full_epochs", "last", "last_rows")
    plan_ = plan_.select(*levels, *[F.col(c).alias(f"_{c}") for c in plan_.columns if c not in levels])
    key = _order_key(seed, F.col("_full_epochs"), F.col("doc_id"))
    here = F.struct(key.alias("k"), F.col("doc_id").alias("d"), _text_hash(docs).alias("t"))
    placed = _null_safe(docs, plan_, levels)
    is_last = F.coalesce(here.eqNullSafe(F.col("_last")), F.lit(False)) & F.col("_last").isNotNull()
    # Rows that are the last one of their leaf, nearly always one: numbered, to take as many as fit.
    ends = placed.filter(is_last).select(
        F.struct(*columns).alias("_document"), *[F.col(c).alias(f"_at_{i}") for i, c in enumerate(levels)],
        "_leaf_tokens", "_budget", "_full_epochs", "_last_rows",
        F.lit(1).alias("_one"), F.monotonically_increasing_id().alias("_row"),
    )
    numbered = ordered_scan(ends, keys=[f"_at_{i}" for i in range(len(levels))], order=["_row"], sums={"_nth": "_one"})
    added = ["_leaf_tokens", "_budget"]
    others = placed.filter(~is_last).select(
        F.struct(*columns).alias("_document"), *added, _epochs(F.coalesce(here < F.col("_last"), F.lit(False))).alias("_epochs")
    )
    of_ends = numbered.select("_document", *added, _epochs(F.col("_nth") < F.col("_last_rows")).alias("_epochs"))
    taken = others.unionByName(of_ends).withColumn("_epoch", F.explode("_epochs"))
    return taken.select("_document.*", "_epoch", *added)


def _epochs(once_more: Column) -> Column:
    """The epochs in which a document is read."""
    taken = F.col("_full_epochs") + F.when(once_more, 1).otherwise(0)
    return F.when(taken > 0, F.sequence(F.lit(0), taken - 1))
