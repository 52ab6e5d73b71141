"""The corpus pipeline: documents in, pieces of packed training sequences out.

Each stage takes what the one before it kept, as a written table, and gives documents in the
columns it was given; the last gives pieces. ``run`` applies all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import mixing, near_dedup, packing, quality, queries, secrets
from carelake.session import stage, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rules or the estimated rules reject. The texts are
    measured once: the table that the model is fitted on holds them with their measures.

    NULL and empty texts fail the base rules; repeated rows are judged alike; an empty table
    stays empty; other columns pass through.
    """
    measured = stage(docs.select(F.struct("*").alias("row"), quality.measures(docs["text"]).alias("of")), "measured")
    return quality.judge(measured, "of").filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id. Rows without
    text are no duplicates and stay; of repeated rows one stays."""
    return near_dedup.keep_one(docs, near_dedup.near_duplicates(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each secret in place of it, and ``n_chars`` as it is then.
    NULL texts stay NULL; repeated rows are searched each."""
    found = secrets.scan(docs.select("doc_id", "text", F.struct("*").alias("row")))
    clean = F.when(F.col("text").isNotNull(), secrets.redact(F.col("text"), F.col("secrets")))
    found = found.select("row", F.size("secrets").alias("n"), clean.alias("clean"))
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    length = F.when(F.col("n") > 0, F.length("clean").cast("long"))
    new = {"text": F.col("clean"), "n_chars": F.coalesce(length, own.get("n_chars", F.lit(None)))}
    return found.select(*[new.get(c, own[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a mixture of as many tokens takes: one row for each epoch in which a
    document is read. Documents without words belong to no budget and are not taken."""
    levels = ("_domain", *queries.MIX_LEVELS[1:])
    named = queries.with_domain(docs.select("doc_id", "text", "lang", "source", F.struct("*").alias("_document")), into="_domain")
    _, leaves = mixing.plan(named, levels, queries.MIX_WEIGHTS, seed=queries.MIX_SEED)
    return mixing.select(named, leaves, levels, seed=queries.MIX_SEED).select("_document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; a document that is read in
    two epochs is packed twice."""
    return queries.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mix),
    ("packing", pack),
]

# Estimated rules, components and token ids are beyond SQL; tests/llm hold ``run`` against a
# version of it without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, build) in enumerate(STAGES, 1):
        docs = build(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"stage-{number}")
    return docs
