"""Token records: sequences encoded, framed with lengths and masked checksums, and indexed.

File format. A file is a run of records, each of them:

    uint64 length of the payload | uint32 masked checksum of those 8 bytes |
    payload | uint32 masked checksum of the payload | one line feed

all little-endian. A payload is: int64 document id, uint8 flags (1: the id is NULL),
uint8 bytes per token (2 or 4), then the token ids. The masked checksum is
``rotate_right(crc32, 15) + 0xA282EAD8`` modulo 2**32, so that a checksum over bytes that
hold checksums stays sound. Files are written by Spark's own writer, hence to any store it
reaches, and a failed task leaves nothing behind. The line feed ends a row of that writer.
The index is a table of its own: a reader seeks to ``offset`` in ``file`` in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import new_folder, small_batches, stage, text_of
from riskframe.llm.tokens import encoder

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
LABEL = struct.Struct("<qBB")
MASK = 0xA282EAD8
#: Bytes of records that a task collects, and such blocks in a file: what a reader holds at once.
BLOCK_BYTES, BLOCKS_PER_FILE = 8 << 20, 8


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    payload = LABEL.pack(doc_id or 0, doc_id is None, 4 if wide else 2) + ids.astype("<u4" if wide else "<u2").tobytes()
    head = struct.pack("<Q", len(payload))
    return head + TAIL.pack(masked(head)) + payload + TAIL.pack(masked(payload))


def frames_of(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, id, token ids as uint32) of each record; a wrong checksum is an error."""
    at = 0
    while at < len(content):
        size, check = HEAD.unpack_from(content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"Wrong checksum of a length at byte {at}")
        payload = content[at + HEAD.size : at + HEAD.size + size]
        length = HEAD.size + size + TAIL.size
        if len(payload) < size or masked(payload) != TAIL.unpack_from(content, at + HEAD.size + size)[0]:
            raise ValueError(f"Wrong checksum of a record at byte {at}")
        doc_id, missing, width = LABEL.unpack_from(payload)
        ids = np.frombuffer(payload, f"<u{width}", offset=LABEL.size).astype("<u4")
        yield at, length, None if missing else doc_id, ids
        at += length + 1


def _framer(path: str, end_id: int, block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(path), np.array([end_id], "<u4").tobytes()
        frames, size = [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join(frames)], pa.binary())], ["block"])

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                found = frame(i.as_py(), np.frombuffer(words.encode(text.as_buffer().to_pybytes()) + end, "<u4"))
                if frames and size + len(found) > block_bytes:
                    yield block()
                    frames, size = [], 0
                frames.append(found)
                size += len(found)
        if frames:
            yield block()

    return run


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, block_bytes: int = BLOCK_BYTES, blocks: int = BLOCKS_PER_FILE
) -> None:
    """Write every text's ids in ascending ``doc_id`` order (NULL first; equal ids by a hash of the text).

    ``tokenizer`` is the path of a tokenizer file that all workers can open. Records are
    handed to the writer in blocks of at most ``block_bytes``, or one longer record, and
    a file takes ``blocks`` of them, so its size is bounded. Rows that share an id, or an
    id and a text, are spread over tasks.
    """
    small_batches(docs.sparkSession)
    text = text_of()
    order = ["id", "hash", "spread"]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
        .withColumn("spread", F.rand(3))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("id", "text")
    )
    frames = ordered.mapInArrow(_framer(tokenizer, end_id, block_bytes), "block binary")
    # The text writer writes a string's bytes as they are.
    writer = frames.select(F.col("block").cast("string").alias("value")).write
    writer.option("lineSep", "\n").option("maxRecordsPerFile", blocks).text(folder)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            name, start, rows = path.as_py(), 0, []
            for offset, length, doc_id, ids in frames_of(content.as_py()):
                rows.append((doc_id, name, offset, length, start, len(ids), zlib.crc32(ids)))
                start += len(ids)
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), INDEX_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, INDEX_NAMES)


INDEX_SCHEMA = "doc_id long, file string, offset long, length long, start_in_file long, n_tokens long, ids_crc32 long"
INDEX_NAMES = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
INDEX_TYPES = [pa.string() if n == "file" else pa.int64() for n in INDEX_NAMES]


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Read the record files back, check every checksum, and list their records."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(_parse, INDEX_SCHEMA)


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write records and their index; one row per document from the files read back.

    Columns: doc_id, start (ids in all documents before it), n_tokens (with the end id),
    ids_crc32, file, offset, length. NULL and empty texts hold the end id alone; repeated
    rows are repeated records; an empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark)
    write_records(docs, f"{folder}/records", tokenizer, end_id)
    read_index(spark, f"{folder}/records").write.parquet(f"{folder}/index")
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    # part-<task>-<uuid>-c<file>: the order of files is the order of ids
    order = [F.regexp_extract("file", p, 1).cast("long") for p in (r"part-(\d+)-", r"-c(\d+)[^/]*$")]
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("before_file"))
    return index.join(files, "file").select(
        "doc_id", (F.col("before_file") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32",
        "file", "offset", "length",
    )


def decode_records(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sequences: doc_id and ids."""
    def run(batches):
        for batch in batches:
            for content in batch.column(1):
                rows = [(d, ids.tolist()) for _, _, d, ids in frames_of(content.as_py())]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                        ["doc_id", "ids"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")
    return files.select("path", "content").mapInArrow(run, "doc_id long, ids array<long>")
