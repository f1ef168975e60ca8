"""Token ids as length-delimited binary records with an offset index.

A record is ``length (u64) | masked checksum of the length | payload | masked
checksum of the payload``; all numbers are little-endian.  The payload is
``has id (u8) | id (i64) | token ids (u16 or u32)``.  Checksums are CRC-32,
rotated right by 15 bits plus a constant, so that a checksum of data that hold
checksums stays sound.  Beside each record file an index file holds
``id (i64) | offset (u64) | tokens (u32)`` per record, for reads in any order.

Files are written by the tasks of one job.  A file's name holds its attempt, and
only files in the manifest count, so a lost executor or a second attempt leaves
at most a file that nobody reads.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, text_or_empty
from .tokens import library_encoder

_MASK, _ROTATE = 0xA282EAD8, 15
_LENGTH, _CHECK, _HEAD, _INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<Bq"), struct.Struct("<qQI")
OVERHEAD = _LENGTH.size + 2 * _CHECK.size
MANIFEST = "part int, file string, records long, tokens long, bytes long, dtype string"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> _ROTATE | c << (32 - _ROTATE)) + _MASK) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    size = _LENGTH.pack(len(data))
    return b"".join((size, _CHECK.pack(masked(size)), data, _CHECK.pack(masked(data))))


def unframe(data, at: int = 0) -> tuple[bytes, int]:
    """(payload, offset behind the record); ValueError if a checksum differs."""
    size = bytes(data[at:at + _LENGTH.size])
    body = at + _LENGTH.size + _CHECK.size
    if len(size) < _LENGTH.size or _CHECK.unpack_from(data, at + _LENGTH.size)[0] != masked(size):
        raise ValueError(f"damaged record length at {at}")
    end = body + _LENGTH.unpack(size)[0]
    body_bytes = bytes(data[body:end])
    if end + _CHECK.size > len(data) or _CHECK.unpack_from(data, end)[0] != masked(body_bytes):
        raise ValueError(f"damaged record at {at}")
    return body_bytes, end + _CHECK.size


def payload(key: int | None, ids: bytes) -> bytes:
    return _HEAD.pack(key is not None, key or 0) + ids


def index_entry(key: int | None, offset: int, n: int) -> bytes:
    return _INDEX.pack(key or 0, offset, n)


def open_fs(uri: str):
    """(file system, path) of a local path or any URI that Arrow knows."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _write(folder: str, tokenizer: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        enc = library_encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], dtype=enc.dtype).tobytes()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        offset = records = tokens = 0
        with fs.open_output_stream(f"{path}/{name}.rec") as out, fs.open_output_stream(f"{path}/{name}.idx") as index:
            for b in slices(batches, 1024):
                texts = enc.batch(b.column("t").to_pylist())
                for i, ids in zip(b.column("_id").to_pylist(), texts, strict=True):
                    ids = ids.tobytes() + end
                    n = len(ids) // np.dtype(enc.dtype).itemsize
                    record = frame(payload(i, ids))
                    out.write(record)
                    index.write(index_entry(i, offset, n))
                    offset, records, tokens = offset + len(record), records + 1, tokens + n
        if records:
            yield pa.RecordBatch.from_pylist([{
                "part": task.partitionId(), "file": name, "records": records, "tokens": tokens, "bytes": offset,
                "dtype": enc.dtype}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()),
                                                 ("tokens", pa.int64()), ("bytes", pa.int64()), ("dtype", pa.string())]))
    return run


def write_records(df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int | None = 0, files: int | None = None) -> DataFrame:
    """Tokenize ``text_col`` and write all rows in ascending id order (null ids
    first; equal ids by text hash) into ``folder``; returns the manifest, which
    is also written to ``folder/manifest``.

    Ids are integers.  Null or empty texts give a record of the end id alone.
    Repeated rows give a record each.  An empty table gives an empty manifest.
    Other columns are not read.  ``files``: record files, by default the shuffle
    partitions.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("t"))
    # one job: the ranges are sampled once, and what the files hold is the order
    (rows.repartitionByRange(files, "_id").sortWithinPartitions("_id", F.xxhash64("t"))
     .mapInArrow(_write(f"{folder}/data", tokenizer, end_id), MANIFEST)
     .write.parquet(f"{folder}/manifest"))
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order; ``before``: tokens in all files before each (one row
    per file)."""
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
            .withColumn("before", F.coalesce(F.sum("tokens").over(w), F.lit(0)).cast("long")))


#: Bytes read at a time in file order.
BLOCK = 8 << 20


def read_file(folder: str, name: str, dtype: str, shuffle_seed: int | None = None) -> Iterator[tuple]:
    """(id, tokens before it in the file, ids) of each record of a file, through
    its index: in file order, by long reads, or in a seeded random order, by a read per
    record.  Every checksum is checked."""
    fs, path = open_fs(folder)
    with fs.open_input_file(f"{path}/{name}.idx") as f:
        index = np.frombuffer(f.read(), dtype=[("id", "<i8"), ("at", "<u8"), ("n", "<u4")])
    start = np.cumsum(index["n"], dtype=np.int64) - index["n"]
    size = OVERHEAD + _HEAD.size + index["n"].astype(np.int64) * np.dtype(dtype).itemsize
    at = index["at"].astype(np.int64)

    def record(i: int, data) -> tuple:
        body, _ = unframe(data)
        has, key = _HEAD.unpack_from(body)
        return key if has else None, int(start[i]), np.frombuffer(body, dtype=dtype, offset=_HEAD.size)

    with fs.open_input_file(f"{path}/{name}.rec") as f:
        if shuffle_seed is not None:
            order = list(range(len(index)))
            random.Random(f"{shuffle_seed}:{name.rsplit('-', 1)[0]}").shuffle(order)
            for i in order:
                yield record(i, f.read_at(int(size[i]), int(at[i])))
            return
        first = 0
        while first < len(index):  # whole records that a block holds, one at least
            end = max(first + 1, int(np.searchsorted(at + size, at[first] + BLOCK, side="right")))
            data = memoryview(f.read_at(int(at[end - 1] + size[end - 1] - at[first]), int(at[first])))
            for i in range(first, end):
                begin = int(at[i] - at[first])
                yield record(i, data[begin:begin + int(size[i])])
            first = end


def read_records(spark: SparkSession, folder: str, shuffle_seed: int | None = None) -> DataFrame:
    """(_id, ``start``: tokens of all records before it, ``n_tokens``, ``ids_u32``:
    ids as little-endian 32-bit integers), one file per task at most."""
    manifest = read_manifest(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows):
            i, s, n, b = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(s, pa.int64()),
                                               pa.array(n, pa.int64()), pa.array(b, pa.binary())],
                                              ["_id", "start", "n_tokens", "ids_u32"])
        for batch in batches:
            for m in batch.to_pylist():
                rows, held = [], 0
                for key, start, ids in read_file(f"{folder}/data", m["file"], m["dtype"], shuffle_seed):
                    rows.append((key, m["before"] + start, len(ids), ids.astype("<u4").tobytes()))
                    held += len(rows[-1][3])
                    if held > 4 << 20:
                        yield emit(rows)
                        rows, held = [], 0
                if rows:
                    yield emit(rows)

    # dealt out in turn, not by hash: each file is a unit of about the same size
    return manifest.repartition(max(1, manifest.count())).mapInArrow(
        run, "_id long, start long, n_tokens long, ids_u32 binary")
