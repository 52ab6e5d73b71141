"""Token ids in files of framed binary records, with an index of offsets beside them.

A record is, little-endian:

    length of the payload, 8 bytes | masked CRC-32 of these 8 bytes, 4 | payload | its masked CRC-32, 4

and the payload: bytes per id (1 byte: 2 or 4), whether there is a doc_id (1), doc_id (8), ids.
The mask rotates a checksum by 15 bits and adds a constant, so that a payload holding records
does not carry its own valid checksum.

The index is a Parquet table with a row per record: ``doc_id, file, file_no, offset, length,
n_tokens, first`` (ids before it in its file). It is what makes shuffled reading possible, and
what says which files count: each attempt of a task writes a file of its own, and only the
attempt that Spark commits gets its rows into the index.

Defined results: NULL text is the empty text, NULL doc_id comes first and stays NULL; rows with
equal doc_id are ordered by a hash of their text; repeated rows are a record each; an empty
table gives an empty index; columns but doc_id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import small_batches

INDEX = "doc_id long, file string, file_no int, offset long, length long, n_tokens long, first long"
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_PAYLOAD = struct.Struct("<BBq")
_CRC = struct.Struct("<I")


class CorruptRecord(ValueError):
    """A checksum, a length or a number of ids is not what the file or the index says."""


def _masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def payload(doc_id: int | None, ids: bytes | memoryview, width: int) -> bytes:
    return b"".join((_PAYLOAD.pack(width, doc_id is not None, doc_id or 0), ids))


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a payload."""
    width, has_id, doc_id = _PAYLOAD.unpack_from(payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", offset=_PAYLOAD.size)


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + _CRC.pack(_masked(length)) + payload + _CRC.pack(_masked(payload))


def unframe(data: bytes | memoryview, at: int = 0) -> bytes:
    """The payload of the record that begins at ``at``."""
    if len(data) < at + _HEAD.size:
        raise CorruptRecord("cut short in a length")
    length, crc = _HEAD.unpack_from(data, at)
    if _masked(bytes(data[at : at + 8])) != crc:
        raise CorruptRecord("checksum of a length")
    start = at + _HEAD.size
    if len(data) < start + length + _CRC.size:
        raise CorruptRecord("cut short in a payload")
    payload = bytes(data[start : start + length])
    if _CRC.unpack_from(data, start + length)[0] != _masked(payload):
        raise CorruptRecord("checksum of a payload")
    return payload


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_records(docs: DataFrame, path: str, tokenizer: str, *, end_id: int) -> None:
    """Write the ids of ``docs(doc_id, text)``, ascending by doc_id over the files by number and
    within each, to ``path/data`` and the index to ``path/index``.

    Documents are dealt by ranges of doc_id as *texts*: the bounds are sampled from the input,
    which would otherwise be tokenized twice.
    """
    small_batches(docs.sparkSession)
    data = f"{path}/data"
    _filesystem(data)  # fails here rather than in a task if the scheme has no writer

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.tokens import encoder

        task, own = TaskContext.get(), encoder(tokenizer)
        width, name = own.dtype.itemsize, f"{task.partitionId():06d}-{uuid.uuid4().hex}.rec"
        filesystem, place = _filesystem(f"{data}/{name}")
        filesystem.create_dir(place.rpartition("/")[0], recursive=True)
        offset = first = 0
        with filesystem.open_output_stream(place, buffer_size=1 << 20) as file:
            for batch in batches:
                doc_ids, rows = batch.column(0).to_pylist(), []
                for start, ids, ends in own.parts(batch.column(1), end_id):
                    raw = memoryview(ids.tobytes())
                    ends = ends.tolist()
                    for doc_id, a, b in zip(doc_ids[start : start + len(ends)], [0, *ends], ends, strict=False):
                        record = frame(payload(doc_id, raw[width * a : width * b], width))
                        file.write(record)
                        rows.append((doc_id, name, task.partitionId(), offset, len(record), b - a, first))
                        offset, first = offset + len(record), first + b - a
                yield _batch(rows)

    key = [F.col("doc_id"), F.xxhash64("text")]
    ordered = docs.select(docs["doc_id"].cast("long"), docs["text"]).repartitionByRange(*key)
    index = ordered.sortWithinPartitions(*key).mapInArrow(write, INDEX)
    index.write.parquet(f"{path}/index")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in INDEX.split(", ")])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_records(index: DataFrame, path: str) -> DataFrame:
    """``doc_id, file_no, first, ids`` of the records that ``index`` names, in any order and
    number: ``ids`` are little-endian unsigned 32-bit integers. A record that is not what its
    checksums and its index row say raises."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            names, numbers = batch.column(0).to_pylist(), batch.column(1)
            offsets, lengths, counts = (batch.column(i).to_pylist() for i in (2, 3, 4))
            doc_ids, found = [], []
            for name, offset, length, count in zip(names, offsets, lengths, counts, strict=True):
                if name != opened:
                    filesystem, place = _filesystem(f"{path}/data/{name}")
                    opened, file = name, filesystem.open_input_file(place)
                doc_id, ids = parse(unframe(file.read_at(length, offset)))
                if len(ids) != count:
                    raise CorruptRecord(f"{len(ids)} ids, and {count} in the index")
                doc_ids.append(doc_id)
                found.append(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), numbers, batch.column(5), pa.array(found, pa.binary())],
                names=["doc_id", "file_no", "first", "ids"],
            )

    small_batches(index.sparkSession)
    return index.select("file", "file_no", "offset", "length", "n_tokens", "first").mapInArrow(
        read, "doc_id long, file_no int, first long, ids binary"
    )


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``records`` with ``start``, the ids of all records before. One row per file is summed up
    and broadcast; files are as many as the partitions of the job that wrote them."""
    sizes = index.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return records.join(F.broadcast(bases), "file_no").select(
        *records.columns, (F.col("_base") + F.col("first")).alias("start")
    )
