"""Damage to conversations, and the repair of their structure by alignment with a grammar.

Rows are numbered within their conversation by ``ordered_scan``, which divides a conversation of
any size; of each row only a letter goes on (see ``turn_alignment``). Letters are gathered into
segments of ``SEGMENT`` turns, each aligned by itself, and a chain of segments makes the audit. The
repaired text is hashed turn by turn as it streams by, sorted, next to its audit: a digest of one
long text is made in one place, but neither its turns nor its text are ever held together there.
The audit is: one value of a byte per turn.

Defined results: NULL in a role, a text or the names that decide the damage is one space; NULL
turns come first and do not count as gaps; rows of equal turn are ordered by role and by digest of
text; repeated rows are turns of their own, the later ones duplicates; a NULL conv_id is a
conversation; one without rows after the damage has zeros, an empty audit and the digest of the
empty text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import small_batches
from carelake.operators.joins import join_back
from carelake.operators.ordering import ordered_scan
from carelake.session import stage

SEGMENT = 256
SPACES = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
_ORDER = ["turn", "role", "text_md5", "row", "copy"]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy`` of ``rows`` of ``conv_id, turn, role, text``: of twenty
    rows one is dropped, one emptied, one loses its sentence marks, one is repeated (``copy`` 1),
    and one becomes the user's."""

    def spaced(name: str):
        return F.coalesce(rows[name].cast("string"), F.lit(" "))

    named = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    kind = F.crc32(F.encode(named, "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter(kind != 0).select(
        rows["conv_id"].cast("long"), rows["turn"].cast("long"),
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """Per turn of a stored table of ``conv_id, turn, role, text, text_md5, row, copy``: its
    position, its initial, that of the turn before, and its fault."""
    said = F.rtrim("text", F.lit(SPACES))
    marked = turns.select(
        "conv_id", *_ORDER,
        F.substring("role", 1, 1).alias("initial"),
        (said == "").alias("blank"),
        (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.lit(1).alias("one"),
    )
    placed = ordered_scan(marked, keys=["conv_id"], order=_ORDER, sums={"position": "one"}, previous={"before": "initial"})
    placed = stage(placed.drop("one"), "positions")
    first = placed.groupBy("conv_id", "role", "text_md5").agg(F.min("position").alias("first"))
    known = join_back(placed, first, ["conv_id", "role", "text_md5"])
    fault = F.when(F.col("blank"), "blank").when(F.col("position") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    return known.select("conv_id", "turn", "position", "initial", "before", fault.alias("fault"))


def summary(marked: DataFrame) -> DataFrame:
    """Per conversation: missing turns, faults, and neighbours that the grammar does not allow."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    pair = F.concat("before", "initial")
    return marked.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if(~pair.isin("su", "ua", "au")).alias("illegal"),
    )


def letters(marked: DataFrame, segment: int) -> DataFrame:
    """``conv_id, part, turns``: the letters of at most ``segment`` turns each."""
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    )
    grouped = marked.groupBy("conv_id", F.floor(F.col("position") / segment).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("position", letter.alias("letter")))).alias("all")
    )
    return grouped.select("conv_id", "part", F.array_join(F.transform("all", lambda t: t["letter"]), "").alias("turns"))


def audits(parts: DataFrame) -> DataFrame:
    """``conv_id, cost, audit`` of ``conv_id, part, turns``."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.turn_alignment import ENTRIES, START, align

        kind = pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
        for batch in batches:
            found = []
            for part, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                entries = ENTRIES if part else (START,)
                found.append([(e, x, cost, audit) for e in entries for x, (cost, audit) in align(turns, e).items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, kind)], names=["conv_id", "part", "options"]
            )

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.turn_alignment import chain

        def options():
            for batch in batches:
                columns = (batch.column(i).to_pylist() for i in range(3))
                yield from zip(*columns, strict=True)

        def of_conversation(rows, first):
            by_entry: dict = {}
            nonlocal held
            while first is not None:
                by_entry = {}
                for o in first[2]:
                    by_entry.setdefault(o["entry"], {})[o["exit"]] = (o["cost"], o["audit"])
                yield by_entry
                following = next(rows, None)
                held = following
                first = following if following is not None and first[1] > 0 else None

        rows = options()
        held = next(rows, None)
        out: list[tuple] = []
        while held is not None:
            conversation = held[0]
            best = chain(of_conversation(rows, held))
            out.append((conversation, best.cost, "".join(best.pieces())))
            if len(out) == 256:
                yield _audit_batch(out)
                out = []
        yield _audit_batch(out)

    small_batches(parts.sparkSession)
    option = "array<struct<entry:string,exit:string,cost:long,audit:string>>"
    options = parts.mapInArrow(aligned, f"conv_id long, part long, options {option}")
    ordered = options.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"))
    return ordered.mapInArrow(chained, "conv_id long, cost long, audit string")


def _audit_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "cost", "audit"]
    )


class Repair:
    """The digest of one repaired conversation, fed with its turns in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.said = audit, 0, 0
        self.odd = sum(audit.count(c) for c in "KRI") % 2
        self.digest = hashlib.sha256()

    def _say(self, role: str | None, text: str) -> None:
        role = role or ROLES["ua"[(self.said - self.odd) % 2]]
        self.digest.update((f"\n{role}:{text}" if self.said else f"{role}:{text}").encode())
        self.said += 1

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._say(None, "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else None, text)

    def end(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def digests(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, repaired_sha256``: each audit goes before the turns of its
    conversation, and they pass by one after the other."""

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.conversations import Repair

        def done(row, repair):
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.int64()), pa.array([repair.audit]), pa.array([repair.end()])],
                names=["conv_id", "cost", "audit", "repaired_sha256"],
            )

        row = repair = None
        for batch in batches:
            out = []
            for one in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if one[1] is None:
                    repair.turn(one[2], one[3])
                    continue
                if repair:
                    out.append(done(row, repair))
                row, repair = one, Repair(one[3])
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if repair:
            yield done(row, repair)

    small_batches(turns.sparkSession)
    none = [F.lit(None).cast(k).alias(c) for c, k in zip(_ORDER, ("long", "string", "string", "long", "int"), strict=True)]
    both = turns.select("conv_id", F.lit(None).cast("long").alias("cost"), *_ORDER, "text").unionByName(
        audited.select("conv_id", "cost", *none, F.col("audit").alias("text"))
    )
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("cost").isNull(), *_ORDER)
    return ordered.select("conv_id", "cost", "role", "text").mapInArrow(
        repaired, "conv_id long, cost long, audit string, repaired_sha256 string"
    )


def repair(rows: DataFrame, *, segment: int = SEGMENT) -> DataFrame:
    """The conversations of ``rows(conv_id, turn, role, text)``, as they are after ``damage``: their
    faults, and how they are repaired. One row per conv_id of ``rows``."""
    turns = damage(rows).withColumns({"text_md5": F.md5("text"), "row": F.monotonically_increasing_id()})
    turns = stage(turns, "turns")
    marked = stage(faults(turns), "faults")
    audited = stage(audits(letters(marked, segment)), "audits")
    repaired = digests(turns, audited)
    found = stage(join_back(summary(marked), repaired, ["conv_id"]), "repaired")
    known = found.withColumnRenamed("conv_id", "_conv")
    every = stage(rows.select(rows["conv_id"].cast("long").alias("conv_id")).distinct(), "conversations")
    joined = every.join(known, every["conv_id"].eqNullSafe(known["_conv"]), "left").drop("_conv")
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    return joined.fillna({**zeros, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})
