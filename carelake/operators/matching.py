"""Party matching without forming the pairs of a block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.fixed_values import MATCH_RULES
from carelake.functions.identity import auto_link, match_confidence
from carelake.operators.joins import join_back
from carelake.session import stage

MATCH_FIELDS = ["email_norm", "phone_norm", "name_key", "date_of_birth", "postcode"]
_WIDEST_RULE = max(len(fields) for _, _, fields in MATCH_RULES)
_VALUES = ["rule", *[f"k{i}" for i in range(_WIDEST_RULE)]]
# Sorts compare the hash of the values first, which seldom is equal in two blocks.
_BLOCK = ["h", *_VALUES]


def _memberships(parties: DataFrame) -> DataFrame:
    """One row per party and rule whose fields it has, with the values it must share."""
    entries = []
    for rule, _, fields in MATCH_RULES:
        values = [F.col(f).cast("string") for f in fields]
        complete = F.lit(True)
        for v in values:
            complete = complete & v.isNotNull() & (v != "")
        padded = values + [F.lit("")] * (_WIDEST_RULE - len(values))
        entry = F.struct(F.lit(rule).alias("rule"), *[v.alias(f"k{i}") for i, v in enumerate(padded)])
        entries.append(F.when(complete, entry))
    return parties.withColumn("_m", F.explode(F.array_compact(F.array(*entries)))).select(
        *parties.columns, "_m.*"
    )


def match_blocks(parties: DataFrame) -> DataFrame:
    """Party, rule, and the smallest party key of its block, for blocks of two or more.

    Equality is transitive within a rule, so two parties match by a rule exactly when they
    are in one block of it. One row per member therefore says what all pairs of the block
    would say, in linear instead of quadratic size. ``anchor`` carries the match fields of
    the block's smallest party.
    """
    members = stage(_memberships(parties.select("party_key", *MATCH_FIELDS)), "members")
    members = members.withColumn("h", F.xxhash64(*_VALUES))
    blocks = (
        members.groupBy(*_BLOCK)
        .agg(
            F.min(F.struct("party_key", *MATCH_FIELDS)).alias("anchor"),
            F.count("*").alias("block_size"),
        )
        .filter("block_size > 1")
    )
    return join_back(members, blocks, _BLOCK).drop("h")


def match_links(parties: DataFrame) -> DataFrame:
    """``party_key, anchor_key, confidence, auto_link``: each party linked to the smallest
    party of every block it is in, scored on all fields of the two."""
    blocks = match_blocks(parties).filter("party_key <> anchor.party_key")
    confidence = match_confidence(
        {f: F.col(f) for f in MATCH_FIELDS}, {f: F.col(f"anchor.{f}") for f in MATCH_FIELDS}
    )
    return (
        blocks.select("party_key", F.col("anchor.party_key").alias("anchor_key"), confidence.alias("c"))
        .groupBy("party_key", "anchor_key")
        .agg(F.max("c").alias("confidence"))
        .withColumn("auto_link", auto_link(F.col("confidence")))
    )


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Add ``confidence`` and ``auto_link`` to given candidate pairs, whose two records are
    the struct columns ``a`` and ``b``."""
    confidence = match_confidence(
        {f: F.col(f"a.{f}") for f in MATCH_FIELDS}, {f: F.col(f"b.{f}") for f in MATCH_FIELDS}
    )
    return pairs.withColumn("confidence", confidence).withColumn(
        "auto_link", auto_link(F.col("confidence"))
    )
