"""Secret scans over an inverted index of trigrams, in DataFrame operations alone.

Each rule's expression gives a Boolean query over trigrams (``trigram_query``). Posting lists
are built of the trigrams that the queries ask for, their intersections name candidate
documents per rule, and only those are searched. Rules whose expression has no trigram that
every match contains are searched in all documents.

Defined results: NULL text is the empty text and has no secrets; rows that share a doc_id share
candidates, which only searches more, and are verified each for itself; an empty table gives
no rows; the columns added give way to none and replace input columns of their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import let, running
from carelake.llm.trigram_query import trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches of ``regex``, leftmost first and without overlap, whose ``group`` has at least
    ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # A run of 16 or more is a run of one or more that is long enough.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    # The first part is bounded, so that a long run of its letters is not gone through from each start.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key_block", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
RULES = BASE_RULES + MORE_RULES


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """``trigram, doc_id`` for those of ``trigrams`` that a document's text contains, in lower
    case. Every text is read once, whole."""
    sought = F.array(*[F.lit(t) for t in trigrams])
    lower = F.lower(F.coalesce(docs["text"], F.lit("")))
    held = let(lower, lambda text: F.filter(sought, lambda t: F.contains(text, t)))
    return docs.select(docs["doc_id"], F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``doc_id, kinds``: the rules whose trigram query a document's postings satisfy, for rules
    that have one. Posting lists are intersected by counting, per document, how many lists of
    an alternative it is in."""
    spark = docs.sparkSession
    terms = [
        (rule.kind, n, trigram, len(term))
        for rule in rules
        for n, term in enumerate(trigram_query(rule.regex) or [])
        for trigram in sorted(term)
    ]
    # As many rows as the rules' queries have trigrams, whatever the documents.
    wanted = spark.createDataFrame(terms, "kind string, alternative int, trigram string, lists int")
    lists = postings(docs, sorted({t[2] for t in terms})).distinct()
    return (
        lists.join(F.broadcast(wanted), "trigram")
        .groupBy("doc_id", "kind", "alternative", "lists")
        .agg(F.count("*").alias("in_lists"))
        .filter("in_lists = lists")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _found(text: Column, rule: Rule, place: int) -> Column:
    """The rule's spans in a text, in code points, the end exclusive. ``split`` and
    ``regexp_extract_all`` run over the same matches, so the text is their parts in turn."""
    regex = F.lit(rule.regex)
    parts = F.struct(
        F.split(text, rule.regex, -1).alias("gaps"),
        F.regexp_extract_all(text, regex, 0).alias("matches"),
        F.regexp_extract_all(text, regex, rule.group).alias("groups"),
    )

    def walk(p: Column) -> Column:
        gaps = F.transform(F.slice(p["gaps"], F.lit(1), F.size(p["matches"])), lambda g: F.length(g).cast("long"))
        lengths = F.zip_with(gaps, p["matches"], lambda g, m: F.struct(g.alias("gap"), F.length(m).cast("long").alias("match")))

        def spans(sizes: Column) -> Column:
            before = running(F.transform(sizes, lambda z: z["gap"] + z["match"]), F.lit(0).cast("long"), lambda a, b: a + b)

            def span(i: Column, done: Column) -> Column:
                start = done[i] + sizes[i]["gap"]
                return F.struct(
                    start.cast("int").alias("start"),
                    F.lit(place).alias("place"),
                    (start + sizes[i]["match"]).cast("int").alias("end"),
                    F.lit(rule.kind).alias("kind"),
                    (F.length(p["groups"][i]) >= rule.least).alias("kept"),
                )

            every = F.sequence(F.lit(0), F.size(sizes) - 1)
            return let(before, lambda done: F.filter(F.transform(every, lambda i: span(i, done)), lambda s: s["kept"]))

        return let(lengths, spans)

    return F.when(F.regexp_like(text, regex), let(parts, walk))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with ``secrets``, an array of spans (start, end, kind), by start and then by the
    order of the rules."""
    by_index = {r.kind for r in rules if trigram_query(r.regex)}
    found = candidates(docs, rules).select(F.col("doc_id").alias("_of"), F.col("kinds").alias("_kinds"))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_of")), "left")
    text = F.coalesce(docs["text"], F.lit(""))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string,kept:boolean>>")
    spans = []
    for place, rule in enumerate(rules):
        own = _found(text, rule, place)
        if rule.kind in by_index:
            own = F.when(F.array_contains("_kinds", rule.kind), own)
        spans.append(F.coalesce(own, none))
    plain = F.transform(
        F.sort_array(F.concat(*spans)), lambda s: F.struct(s["start"], s["end"], s["kind"])
    )
    return joined.withColumn("secrets", plain).drop("_of", "_kinds")


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


_CHUNK = 4096


def redact(text: Column, spans: Column) -> Column:
    """``text`` with the kind of each secret, in brackets, in its place; of spans that overlap,
    the first one's, for all that they cover together."""

    def rebuilt(chunks: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            """A part of the text, from the chunks that it lies in."""
            first, last = F.floor(start / _CHUNK).cast("int"), F.floor((end - 1) / _CHUNK).cast("int")
            head = F.substring(chunks[first], start % _CHUNK + 1, F.least(end - start, F.lit(_CHUNK)))
            whole = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            tail = F.substring(chunks[last], F.lit(1), (end - 1) % _CHUNK + 1)
            return F.when(end <= start, "").when(first == last, head).otherwise(F.concat(head, whole, tail))

        ends = F.transform(spans, lambda s: s["end"].cast("long"))
        covered = running(ends, F.lit(0).cast("long"), lambda a, b: F.greatest(a, b))

        def parts(done: Column) -> Column:
            pieces = F.transform(
                F.filter(F.transform(spans, lambda s, i: F.struct(s.alias("s"), done[i].cast("int").alias("at"))), lambda x: x["s"]["start"] >= x["at"]),
                lambda x: F.concat(between(x["at"], x["s"]["start"]), F.lit("["), F.upper(x["s"]["kind"]), F.lit("]")),
            )
            return F.concat(F.array_join(pieces, ""), between(F.array_max(ends).cast("int"), F.length(text)))

        return let(covered, parts)

    in_chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(in_chunks, rebuilt)).otherwise(text)
