"""Token ids in length-delimited binary records, with a separate offset index.

A file is a row of frames in ascending order of documents:

    uint64 length | uint32 masked checksum of the length | payload
    | uint32 masked checksum of the payload | line feed

The payload is int64 id, uint8 (1: the id is null), uint8 bytes per token id,
and the token ids, all little-endian. Checksums are CRC-32, rotated and shifted
by a constant so that checksums of data that holds checksums stay sound. Spark's
text writer carries the bytes (the line feed ends its row), so files land in any
store Spark writes to and a lost executor leaves no half-written file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import session_conf, text_or_empty
from kerbside.llm.tokens import END_ID, encoder, slices
from kerbside.session import Workspace

# A file is one row when it is read back: the reader, Arrow and the worker each hold it whole.
FILE_BYTES = 8 << 20
# Fixed value: the constant that masks checksums.
MASK_DELTA = 0xA282EAD8
_LENGTH = struct.Struct("<QI")
_HEAD = struct.Struct("<qBB")
_CHECK = struct.Struct("<I")
_PER_TEXT_BYTE = 0.8

INDEX_SCHEMA = "file string, ordinal long, offset long, length long, id long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    """Without the line feed, which the writer adds."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return _HEAD.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parsed(payload: bytes | memoryview) -> tuple[int | None, np.ndarray]:
    doc_id, is_null, width = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=_HEAD.size)
    return None if is_null else doc_id, ids.astype("<u4")


def frames(content: bytes) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of every record; raises ValueError where lengths or checksums disagree."""
    view, at = memoryview(content), 0
    while at < len(view):
        payload, end = frame_at(view, at)
        yield at, payload
        at = end


def frame_at(view: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record that starts at ``at``, and where the next one starts."""
    if at + _LENGTH.size > len(view):
        raise ValueError(f"record at {at} is cut off")
    length, check = _LENGTH.unpack_from(view, at)
    if masked(bytes(view[at : at + 8])) != check:
        raise ValueError(f"length of the record at {at} is damaged")
    start = at + _LENGTH.size
    end = start + length + _CHECK.size + 1
    if end > len(view):
        raise ValueError(f"record at {at} is cut off")
    payload = view[start : start + length]
    if masked(payload) != _CHECK.unpack_from(view, start + length)[0] or view[end - 1] != 0x0A:
        raise ValueError(f"record at {at} is damaged")
    return payload, end


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    file_bytes: int = FILE_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    literal: bool = True,
) -> None:
    """Encode whole texts, append the end id, and write them in ascending order of ids, nulls first.

    A null text is empty. Repeated ids are records of their own, in the order of
    their texts. An empty table gives no file, or an empty one. Texts are dealt
    by ranges of (id, hash of the text) before they are encoded, so each is
    encoded once, and a task holds one batch of texts. ``literal`` is that of
    ``TextEncoder``.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, round(size * _PER_TEXT_BYTE / file_bytes))
    order = [F.col("id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer_path, literal)
        width = 2 if encode_texts.vocabulary_size <= 1 << 16 else 4
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, counts = encode_texts.encode_batch(batch.column("text").to_pylist())
                ends = np.cumsum(counts)
                records = [
                    framed(payload_of(doc_id, np.append(ids[end - n : end], np.uint32(END_ID)), width))
                    for doc_id, n, end in zip(batch.column("id").to_pylist(), counts, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])

    encoded = dealt.mapInArrow(encode, "value binary").select(F.col("value").cast("string").alias("value"))
    encoded.write.text(path)


def build_index(spark: SparkSession, path: str, work: Workspace) -> DataFrame:
    """Read the files back, check every record, and store file, offset and what it holds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c, pa.string() if c == "file" else pa.int64())
             for c in ("file", "ordinal", "offset", "length", "id", "n_tokens", "ids_crc32")]
        )
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                found = []
                for offset, payload in frames(content.as_buffer()):
                    doc_id, ids = parsed(payload)
                    found.append((offset, len(payload), doc_id, len(ids), zlib.crc32(ids.tobytes())))
                columns = list(zip(*found, strict=True)) or [()] * 5
                ordinals = range(len(found))
                file = [name.as_py()] * len(found)
                arrays = [pa.array(c, t) for c, t in zip((file, ordinals, *columns), schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    # One file at a time in a task.
    with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        files = spark.read.format("binaryFile").load(path).select("path", "content")
        return work.store(files.mapInArrow(scan, INDEX_SCHEMA), "index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all documents before: one total per file is put in order."""
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("tokens")).collect()
    before, total = [], 0
    for row in sorted(totals, key=lambda r: r.file):  # part numbers are in the order of the ranges
        before.append((row.file, total))
        total += row.tokens
    files = index.sparkSession.createDataFrame(before, "file string, before long")
    inside = "sum(n_tokens) OVER (PARTITION BY file ORDER BY ordinal) - n_tokens"
    return (
        index.withColumn("inside", F.expr(inside))
        .join(F.broadcast(files), "file")
        .withColumn("start", F.col("before") + F.col("inside"))
        .drop("before", "inside")
    )


def read_at(index: DataFrame, path: str, work: Workspace) -> DataFrame:
    """id and token ids of the records an index names, in any order or subset: shuffled reads.

    Offsets are gathered per file and each file is opened once.
    """
    spark = index.sparkSession

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1), strict=True):
                view = memoryview(content.as_buffer())
                records = [parsed(frame_at(view, at)[0]) for at in offsets.as_py()]
                ids = pa.array([r[1] for r in records], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in records], pa.int64()), ids], ["id", "ids"])

    wanted = index.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        files = spark.read.format("binaryFile").load(path).select("path", "content")
        joined = files.join(wanted, files["path"] == wanted["file"]).select("content", "offsets")
        return work.store(joined.mapInArrow(fetch, "id long, ids array<long>"), "read")
