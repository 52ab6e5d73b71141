"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import conversations, lexical, mixing, packing, pseudonyms, quality, records, secrets, simhash, topk
from carelake.llm.common import table
from carelake.llm.near_dedup import near_duplicates
from carelake.llm.sharding import shard_documents
from carelake.llm.substring_dedup import remove_repeats
from carelake.session import new_path, stage, tune

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16
SEQUENCE = 2048
PACKED_END, RECORD_END = 1, 2
PASSAGE_WORDS = 35
VECTOR_SCALE, QUERY_EVERY, TOP_K = 64, 20, 20
RANKED = 10
PSEUDONYM_KEY = "a key of this query, not a secret"
DOMAINS = ("web", "books", "news", "code")
MIX_LEVELS = ("domain", "lang", "source")
MIX_SEED = "mix"
# Nodes that are not named weigh 1.
MIX_WEIGHTS = {
    ("web",): 4, ("books",): 3, ("news",): 2,
    **{(d, lang): w for d in (*DOMAINS, "other") for lang, w in (("en", 6), ("de", 2), ("fr", 2))},
    ("web", "en", "src0"): 3,
}


def tokenizer_file() -> str:
    """The vocabulary of the two tokenizing queries; operators take any file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 16 shards, by the law ``key``."""
    placed = shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op2_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of passages of 35 that occur again."""
    done = remove_repeats(table(spark, sf_dir, "documents"), k=PASSAGE_WORDS)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def with_domain(docs: DataFrame, into: str = "domain") -> DataFrame:
    """The tables name no domain: it is the one of four that a source's number falls to, and
    "other" for sources without a number."""
    number = F.regexp_extract("source", "([0-9]{1,9})$", 1).try_cast("int")
    names = F.array(*[F.lit(d) for d in DOMAINS])
    return docs.withColumn(into, F.coalesce(F.get(names, number % len(DOMAINS)), F.lit("other")))


def op3_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that a mixture of all tokens takes, with the epochs in which they are read."""
    docs = with_domain(table(spark, sf_dir, "documents")).select("doc_id", "text", *MIX_LEVELS)
    counted, leaves = mixing.plan(docs, MIX_LEVELS, MIX_WEIGHTS, seed=MIX_SEED)
    return mixing.select(counted, leaves, MIX_LEVELS, seed=MIX_SEED).select(
        "doc_id", *MIX_LEVELS, "tokens",
        F.col("_epoch").alias("epoch"), F.col("_leaf_tokens").alias("leaf_tokens"), F.col("_budget").alias("leaf_budget"),
    )


def packed(docs: DataFrame) -> DataFrame:
    pieces = stage(packing.cut(docs, tokenizer_file(), length=SEQUENCE, end_id=PACKED_END), "pieces")
    return packing.pack(pieces, length=SEQUENCE).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by pseudonyms of the same format."""
    done = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("pii", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return done.select("doc_id", "text", *[of_kind(k) for k in pseudonyms.KINDS])


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by rules whose accuracies are estimated from all documents."""
    docs = table(spark, sf_dir, "documents")
    measured = stage(docs.select("doc_id", quality.measures(docs["text"]).alias("of")), "measured")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(measured, "of").select(
        "doc_id", *[f"of.{c}" for c in base], "base_failed", "kept", "posterior"
    )


def op7_dual_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector as a query against all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", topk.whole_numbers(rows["embedding"], VECTOR_SCALE).alias("vector"))
    return topk.search(vectors, F.col("vec_id") % QUERY_EVERY == 0, k=TOP_K).drop("query_row")


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as framed records, and read back."""
    path = new_path(spark, "records")
    records.write_records(table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=RECORD_END)
    index = records.read_index(spark, path)
    read = records.with_starts(records.read_records(index, path), index)
    return read.select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of their near-duplicates, named by its smallest document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op10_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scanned for secrets by an inverted index of trigrams."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[of_kind(k) for k in kinds],
        F.sha2(F.encode(secrets.listed(base), "UTF-8"), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprints, and the smallest document that near ones lead to."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item."""
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=RANKED)


def op13_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged, with their faults and the cheapest repair of their structure."""
    return conversations.repair(table(spark, sf_dir, "conversations"))


QUERIES: list[Query] = [
    op1_rendezvous_shards,
    op2_superkmer_dedup,
    op3_hierarchical_mix,
    op4_cutting_stock_packing,
    op5_feistel_pseudonyms,
    op6_weak_supervision,
    op7_dual_tree_topk,
    op8_token_records,
    op9_dart_minhash,
    op10_trigram_secrets,
    op11_simhash,
    op12_k2_treap_search,
    op13_turn_alignment,
]


def all_queries() -> dict[str, Query]:
    def ready(build: Query) -> Query:
        return lambda spark, sf_dir: build(tune(spark), sf_dir)

    return {build.__name__: ready(build) for build in QUERIES}
