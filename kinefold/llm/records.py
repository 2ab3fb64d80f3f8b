"""Token ids as length-delimited binary records with an offset index (operator 8).

File format, all numbers little-endian:

* a record file is a run of frames ``length u64, masked crc u32 of those 8 bytes,
  payload, masked crc u32 of the payload``;
* a payload is ``doc_id i64, flags u32, n u32, n ids``; flag bit 0 says that the
  doc_id is null, the upper half holds the bytes of one id (2 or 4, by the size
  of the vocabulary);
* a checksum c is CRC-32 (zlib), masked as ``rotate_right(c, 15) + 0xA282EAD8``,
  so that a checksum of data with embedded checksums stays strong;
* beside each record file an index file holds, for each record, ``offset u64,
  length u64, doc_id i64, first id u64``, so that a reader can fetch records in
  any order.

Documents are range-partitioned by (doc_id, text hash) and sorted, one file for
each partition, so the files in order hold ascending doc_ids, nulls first.
A file is written under a temporary name and then renamed; a task that runs
again after a lost executor writes the same bytes under the same name.

Null text counts as empty (the end id alone is written).  Repeated rows and
doc_ids give one record each.  An empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import coder, encoded
from .common import new_path, publish, table, text_slices

HEAD = struct.Struct("<qII")
FRAME = struct.Struct("<QI")
#: Bytes read from a file at once.
READ_BYTES = 8 << 20


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return size + masked(size).to_bytes(4, "little") + payload + masked(payload).to_bytes(4, "little")


def frames(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Payloads of a record file that arrives in pieces; a wrong checksum or a cut file raises ValueError."""
    held = b""
    for chunk in chunks:
        held, at = held + chunk, 0
        while len(held) - at >= 12:
            size, check = FRAME.unpack_from(held, at)
            if masked(held[at : at + 8]) != check:
                raise ValueError("the checksum of a record's length is wrong")
            if len(held) - at < size + 16:
                break
            payload = held[at + 12 : at + 12 + size]
            if masked(payload) != int.from_bytes(held[at + 12 + size : at + 16 + size], "little"):
                raise ValueError("the checksum of a record is wrong")
            yield payload
            at += size + 16
        held = held[at:]
    if held:
        raise ValueError("the file ends within a record")


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """The payload for one document; ``ids`` are little-endian unsigned 32-bit numbers."""
    numbers = np.frombuffer(ids, "<u4")
    body = numbers.astype("<u2").tobytes() if width == 2 else ids
    return HEAD.pack(doc_id or 0, width << 16 | (doc_id is None), len(numbers)) + body


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags, n = HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{flags >> 16}", n, HEAD.size)
    return None if flags & 1 else doc_id, ids.astype("<u4")


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_records(docs: DataFrame, path: str, vocab: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Write all documents to ``path`` and return the manifest: one row per file with counts.

    The manifest is computed when the result is used; publish it to write once.
    """
    spark = docs.sparkSession
    folder = path
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        files, base = _file_system(folder)
        files.create_dir(base, recursive=True)
        name, own = f"{base}/part-{part:06d}", uuid.uuid4().hex
        width = 2 if len(coder(vocab).words.pieces) <= 1 << 16 else 4
        last = np.array([end_id], "<u4").tobytes()
        records = tokens = offset = 0
        index: list[bytes] = []
        with files.open_output_stream(f"{name}.{own}.rec") as out:

            def every() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            for batch in every():
                for piece in text_slices(batch, "text"):
                    ids = piece.column("doc_id").to_pylist()
                    block = []
                    for doc_id, raw in zip(ids, encoded(vocab, piece.column("text").to_pylist()), strict=True):
                        frame = framed(pack(doc_id, raw + last, width))
                        index.append(struct.pack("<QQqQ", offset, len(frame), doc_id or 0, tokens))
                        offset, tokens, records = offset + len(frame), tokens + len(raw) // 4 + 1, records + 1
                        block.append(frame)
                    out.write(b"".join(block))
                    if len(index) >= 1 << 16:
                        index = [b"".join(index)]
        with files.open_output_stream(f"{name}.{own}.idx") as out:
            out.write(b"".join(index))
        for kind in ("rec", "idx"):
            files.move(f"{name}.{own}.{kind}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"file": [f"part-{part:06d}"], "part": [part], "records": [records], "tokens": [tokens], "bytes": [offset]})

    return ordered.select("doc_id", "text").mapInArrow(run, "file string, part long, records long, tokens long, bytes long")


def read_records(manifest: DataFrame, path: str) -> DataFrame:
    """Read all files of the manifest: doc_id, place in its file, ids' count and digest, one row per record."""
    folder = path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["base"]
                rows: list[tuple] = []
                with files.open_input_stream(f"{base}/{row['file']}.rec") as f:
                    for payload in frames(iter(lambda f=f: f.read(READ_BYTES), b"")):
                        doc_id, ids = unpack(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) >= 1 << 16:
                            yield _record_rows(rows)
                            rows = []
                yield _record_rows(rows)

    return manifest.select("file", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names)


def fetch(path: str, file: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Some records of one file by their numbers, in the order asked for, through the offset index."""
    files, base = _file_system(path)
    with files.open_input_file(f"{base}/{file}.idx") as f:
        index = np.frombuffer(f.read(), np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("first", "<u8")]))
    out = []
    with files.open_input_file(f"{base}/{file}.rec") as f:
        for k in numbers:
            raw = f.read_at(int(index["length"][k]), int(index["offset"][k]))
            out += [unpack(p) for p in frames(iter([raw]))]
    return out


def with_bases(manifest: DataFrame) -> DataFrame:
    """Add the number of ids in all files before; the manifest has one row per file, so one task sums it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-records")
    written = publish(write_records(table(spark, sf_dir, "documents"), path), "token-manifest")
    shards = max(1, spark.sparkContext.defaultParallelism * 4)
    return read_records(with_bases(written).repartition(shards), path)
