"""Near-duplicate documents: DartMinHash signatures, banded joining, exact verification.

1. Documents of equal text are one node from the start, however many there are.
2. Signatures are cut into bands; nodes that share a band may be near-duplicates. Each band has
   a leader, the node that shares most bands with others, and its nodes are compared with the
   leader only, never all with all.
3. A comparison is exact: the similarity of the sets of shingles of the two texts. It also says
   which of the leader's shingles the other text has, and which others.
4. Connected components of what is similar are the classes.
5. Where nodes that were compared with one leader are of several classes after that, some may be
   similar without the leader being so. From what was kept in step 3 their similarity follows
   exactly: they meet in blocks of a bounded number of nodes, and only links come out of that.
   So no two nodes that share a band stay apart for not having been compared.

Defined results: texts without words, NULL among them, are nobody's duplicates, but equal ones of
each other where not NULL; texts of fewer words than a shingle have one shingle, of all their
words; repeated rows are duplicates; a class is named by its smallest doc_id, NULL if it has
none; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import small_batches
from carelake.operators.components import connected_components
from carelake.session import stage

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES, BAND_ROWS = 128, 4
# Nodes of one leader that a task holds, twice at most.
BLOCK = 1_024


def shingles(words, n: int = SHINGLE):
    """Hashes of the runs of ``n`` words; of all words, if they are fewer."""
    import numpy as np

    from carelake.llm.superkmers import mix, shingle_hashes

    if len(words) >= n or not len(words):
        return shingle_hashes(words, n)
    return mix(shingle_hashes(words, len(words)) + np.uint64(len(words)))


def shingled(texts: pa.Array) -> Iterator[tuple[int, object, object]]:
    """For parts of ``texts``: index of the first text, elements, and how many each text has."""
    import numpy as np

    from carelake.llm.superkmers import hashed_words, parts_of, shingle_hashes

    for first, data, ends in parts_of(texts):
        words, counts = hashed_words(data, ends)
        begins = np.cumsum(counts) - counts
        text_of = np.repeat(np.arange(len(counts)), counts)
        runs = shingle_hashes(words, SHINGLE)
        whole = text_of[: len(runs)] == text_of[SHINGLE - 1 : SHINGLE - 1 + len(runs)]
        elements, owner = runs[whole], text_of[: len(runs)][whole]
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            own = [shingles(words[begins[i] : begins[i] + counts[i]]) for i in short]
            elements, owner = np.concatenate([elements, *own]), np.concatenate([owner, short])
            order = np.argsort(owner, kind="stable")
            elements, owner = elements[order], owner[order]
        yield first, elements, np.bincount(owner, minlength=len(counts))


def sketch(docs: DataFrame, *, weighted: bool = False) -> DataFrame:
    """``doc_id, digest, bands`` of ``docs(doc_id, text)``; no bands without words."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from carelake.llm.dart_minhash import bands, signatures
        from carelake.llm.near_dedup import counted, shingled

        for batch in batches:
            for first, elements, counts in shingled(batch.column(2)):
                owner, weights = np.repeat(np.arange(len(counts)), counts), None
                if weighted:
                    owner, elements, weights = counted(owner, elements)
                values, present = signatures(owner, elements, weights, len(counts), COORDINATES)
                keys = bands(values, BAND_ROWS)
                width = keys.shape[1]
                offsets = np.concatenate([[0], np.cumsum(present) * width]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[present].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(first, len(counts)) for i in (0, 1)] + [lists],
                    names=["doc_id", "digest", "bands"],
                )

    small_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long"), digest(docs).alias("digest"), docs["text"])
    return rows.mapInArrow(sketched, "doc_id long, digest binary, bands array<long>")


def digest(docs: DataFrame):
    return F.unhex(F.md5(F.encode(docs["text"], "UTF-8")))


def counted(owner, elements):
    """Distinct elements of each set, and their counts as weights."""
    import numpy as np

    order = np.lexsort((elements, owner))
    owner, elements = owner[order], elements[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (elements[1:] != elements[:-1])
    start = np.flatnonzero(new)
    return owner[start], elements[start], np.diff(np.append(start, len(owner))).astype(float)


def units(elements, weighted: bool):
    """Distinct elements, ascending; with weights, each occurrence of an element is one of its own,
    so that the similarity of these sets is the weighted one."""
    import numpy as np

    from carelake.llm.superkmers import mix

    if weighted:
        _, values, counts = counted(np.zeros(len(elements), dtype=np.int64), elements)
        nth = np.arange(len(elements)) - np.repeat(np.cumsum(counts) - counts, counts.astype(np.int64))
        elements = mix(np.repeat(values, counts.astype(np.int64)) ^ mix(nth.astype(np.uint64)))
    return np.unique(elements)


def told_by(leader, other) -> tuple[float, bytes, bytes]:
    """Similarity of two sets of units; a bit for each of the leader's that the other one has; and
    what else the other one has."""
    import numpy as np

    both = np.isin(leader, other, assume_unique=True)
    more = np.setdiff1d(other, leader, assume_unique=True)
    either = len(leader) + len(more)
    return int(both.sum()) / either if either else 0.0, np.packbits(both).tobytes(), more.tobytes()


def _compared(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, weighted: bool) -> DataFrame:
    """``a, b, similarity, has, more`` of pairs of a leader a and a node b (see ``told_by``): the
    text of a node is that of its first document."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.near_dedup import elements_of, told_by, units

        for batch in batches:
            left, right = elements_of(batch.column(2)), elements_of(batch.column(3))
            told = [told_by(units(x, weighted), units(y, weighted)) for x, y in zip(left, right, strict=True)]
            columns = [pa.array([t[i] for t in told], k) for i, k in enumerate((pa.float64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=["a", "b", "similarity", "has", "more"]
            )

    texts = docs.select(docs["doc_id"].cast("long").alias("_doc"), digest(docs).alias("_digest"), docs["text"].alias("_text"))
    ends = pairs.select(F.col("a").alias("_end")).unionByName(pairs.select(F.col("b").alias("_end"))).distinct()
    names = nodes.select("node", "first", "digest").join(ends, F.col("node") == F.col("_end"), "left_semi")
    same = names["first"].eqNullSafe(texts["_doc"]) & (names["digest"] == texts["_digest"])
    # A row that is repeated gives its text once.
    of_node = stage(texts.join(names, same).select("node", "_text").dropDuplicates(["node"]), "node-texts")

    def with_text(df: DataFrame, end: str) -> DataFrame:
        return df.join(of_node, df[end] == of_node["node"]).drop("node").withColumnRenamed("_text", f"text_{end}")

    both = with_text(with_text(pairs, "a"), "b").select("a", "b", "text_a", "text_b")
    schema = "a long, b long, similarity double, has binary, more binary"
    return both.mapInArrow(compare, schema)


def elements_of(texts: pa.Array) -> list:
    import numpy as np

    found = []
    for _, elements, counts in shingled(texts):
        found += np.split(elements, np.cumsum(counts)[:-1])
    return found


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """``doc_id, digest, class_id, kept``: one row per row of ``docs``. ``kept`` marks one of each
    class: of the smallest doc_id, and of its rows that of the smallest digest."""
    sketched = stage(sketch(docs, weighted=weighted), "sketches")
    nodes = sketched.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = nodes.filter("digest IS NOT NULL").withColumn("node", F.monotonically_increasing_id())
    nodes = stage(nodes, "nodes")

    pairs = stage(_with_leaders(nodes), "pairs")
    compared = stage(_compared(pairs, nodes, docs, weighted), "compared")
    links = compared.filter(F.col("similarity") >= threshold).select("a", "b")
    component = stage(connected_components(nodes.select("node"), links), "components")

    late = stage(_links_past_leaders(compared, component, threshold), "late-links")
    if not late.isEmpty():
        component = stage(connected_components(nodes.select("node"), links.unionByName(late)), "components")

    classed = nodes.join(component, "node").select("digest", "first", "component")
    class_of = classed.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "digest")).alias("kept"))
    named = classed.join(stage(class_of, "classes"), "component").select(
        F.col("digest").alias("_digest"), F.col("kept.first").alias("class_id"), F.col("kept.digest").alias("_kept")
    )
    named = stage(named, "named")
    joined = sketched.join(named, F.col("digest") == F.col("_digest"), "left")
    of_null = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    kept = F.when(F.col("digest").isNull(), True).otherwise(
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("_kept"))
    )
    return joined.select("doc_id", "digest", of_null.alias("class_id"), kept.alias("kept"))


def _with_leaders(nodes: DataFrame) -> DataFrame:
    """``a, b``: each node with the leaders of its bands. A text with many near copies shares more
    bands than its copies do among themselves, so it is the one to lead where it is."""
    band = nodes.select("node", F.explode("bands").alias("band"))
    shared = band.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stage(shared.select(F.col("band").alias("_band"), "size"), "shared-bands")
    members = stage(band.join(shared, F.col("band") == F.col("_band")).select("band", "node", "size"), "members")
    degree = members.groupBy("node").agg(F.sum("size").alias("degree")).select(F.col("node").alias("_node"), "degree")
    ranked = members.join(stage(degree, "degrees"), F.col("node") == F.col("_node"))
    first = F.struct(F.col("degree"), (-F.col("node")).alias("n"))
    leader = ranked.groupBy("band").agg(F.max(first).alias("top"))
    leader = stage(leader.select(F.col("band").alias("_band"), (-F.col("top.n")).alias("a")), "leaders")
    led = members.join(leader, F.col("band") == F.col("_band")).filter("node <> a")
    return led.select("a", F.col("node").alias("b")).distinct()


def _links_past_leaders(compared: DataFrame, component: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: similar nodes of different components that were compared with the same leader.

    Only leaders are looked at whose nodes are of several components. The nodes of one are dealt
    into blocks, and each pair of blocks meets in one group.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.near_dedup import links_between

        own, rows = None, []
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != own:
                    found += links_between(rows, threshold)
                    own, rows = row[:3], []
                rows.append(row)
            yield _pairs(found)
        yield _pairs(links_between(rows, threshold))

    placed = compared.join(component.withColumnRenamed("node", "b"), "b")
    led = placed.groupBy("a").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    open_ = stage(led.filter("lo < hi").select(F.col("a").alias("_a"), blocks.alias("blocks")), "open-leaders")
    rows = placed.join(open_, F.col("a") == F.col("_a"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [F.col("a"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    dealt = rows.select(*cell, "block", "b", "component", "has", "more").repartition("a", "i", "j")
    return dealt.sortWithinPartitions("a", "i", "j").mapInArrow(search, "a long, b long").distinct()


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])


def links_between(rows: list[tuple], threshold: float) -> list[tuple[int, int]]:
    """Links across the two blocks of a cell, or within its only one: of rows (leader, i, j, block,
    node, component, has, more). What two nodes have in common is what both have of the leader's,
    and what else both have; the latter is counted only where it can matter."""
    import numpy as np

    if len({r[5] for r in rows}) < 2:
        return []
    has = np.unpackbits(np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    has = has.astype(np.float32)
    more = [np.frombuffer(r[7], np.uint64) for r in rows]
    extra = np.array([len(m) for m in more])
    size = has.sum(axis=1).astype(np.int64) + extra
    block, node, component = (np.array([r[i] for r in rows]) for i in (3, 4, 5))
    left = np.flatnonzero(block == rows[0][1])
    right = np.flatnonzero(block == rows[0][2])
    if not len(left) or not len(right):
        return []
    shared = (has[left] @ has[right].T).astype(np.int64)
    at_most = shared + np.minimum(extra[left][:, None], extra[right][None, :])
    total = size[left][:, None] + size[right][None, :]
    open_ = (at_most >= threshold * (total - at_most) - 1e-9) & (component[left][:, None] != component[right][None, :])
    found = []
    for x, y in zip(*np.nonzero(open_), strict=True):
        a, b = left[x], right[y]
        both = shared[x, y] + len(np.intersect1d(more[a], more[b], assume_unique=True))
        if node[a] != node[b] and both and both / (total[x, y] - both) >= threshold:
            found.append((int(min(node[a], node[b])), int(max(node[a], node[b]))))
    return found


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps; of equal rows, one."""
    key = ["_doc", "_digest"]
    kept = classes.filter("kept").select(F.col("doc_id").alias("_d"), F.col("digest").alias("_g")).distinct()
    rows = docs.withColumns({"_doc": docs["doc_id"].cast("long"), "_digest": digest(docs)})
    same = F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_digest").eqNullSafe(F.col("_g"))
    empty = rows.filter("text IS NULL")
    found = rows.filter("text IS NOT NULL").join(kept, same, "left_semi").dropDuplicates(key)
    return found.unionByName(empty).select(*docs.columns)
