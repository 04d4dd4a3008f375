"""Exchange of very many small codes as packed cells.

A row per code would cost an order of magnitude more than the code itself, so
a task collects the codes of many documents and writes one row per (batch,
shard): the codes that fall into the shard, packed, next to the ids of the
documents they come from. Shards are ranges of the (uniform) code. Their
number follows the size of the input, so that a shard stays small however
large the table is, and partitions hold whole shards one after the other:
a task's memory is bounded by one shard, not by its partition.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Codes that one task holds before it writes its cells.
CODES_PER_FLUSH = 250_000
#: Expected codes of a shard, and text bytes of a bucket of documents.
CODES_PER_SHARD = 1_500_000
BYTES_PER_BUCKET = 12 << 20

#: owner: int64 ids; size: uint32 entries of each owner; code: uint64 of each
#: entry; extra: more of each entry; note: more of each owner.
CELL_SCHEMA = "shard int, owner binary, size binary, code binary, extra binary, note binary"
_PARTS = ("owner", "size", "code", "extra", "note")
_CELL = pa.schema([("shard", pa.int32()), *((c, pa.binary()) for c in _PARTS)])


def _map_large_arrays() -> None:
    """Arrays of 64 KB and more get pages of their own, which go back to the
    system when they are freed, instead of fragmenting a worker's heap; Arrow
    buffers come from the same allocator."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 16)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


_map_large_arrays()


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker lives on after
    its task, next to the executor and to other workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches bounded by bytes as well as by rows: rows carry whole
    texts or packed arrays. Shuffle files of finished queries are removed at
    once, not when the driver happens to collect its garbage."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts: one aggregate row."""
    return df.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0


def shard_count(total_codes: float, n: int, per_shard: float = CODES_PER_SHARD) -> int:
    """A multiple of the ``n`` partitions."""
    return n * max(1, ceil(total_codes / per_shard / n))


def bucket_count(total_bytes: int, n: int) -> int:
    """A prime number of buckets, so that ids with a common divisor spread."""
    k = max(n, ceil(total_bytes / BYTES_PER_BUCKET)) | 1
    while any(k % d == 0 for d in range(3, int(k**0.5) + 1, 2)):
        k += 2
    return k


def deal(df: DataFrame, key: str, n: int, *then: str) -> DataFrame:
    """Rows with equal ``key`` in one partition, sorted by it and ``then``."""
    return df.repartitionById(n, F.pmod(F.col(key), F.lit(n)).cast("int")).sortWithinPartitions(key, *then)


def packed(parts: list[np.ndarray]) -> pa.Array:
    """One binary value per array."""
    bounds = np.concatenate([[0], np.cumsum([p.nbytes for p in parts])])
    return sliced(np.concatenate([np.ascontiguousarray(p).view(np.uint8) for p in parts]), bounds)


def sliced(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that are the slices of one array between ``bounds``."""
    raw = np.ascontiguousarray(values)
    offsets = (bounds * raw.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the length of the whole."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def shard_of(code: np.ndarray, shards: int) -> np.ndarray:
    """The shard as a range of the code's upper half: keeps the code's order."""
    return (((code >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int32)


def cells(
    shard: np.ndarray, owner: np.ndarray, code: np.ndarray, extra: np.ndarray | None = None, note: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Cells of entries sorted by shard; ``extra`` and ``note`` are given for
    each entry. Inside a cell the entries are grouped by owner."""
    bounds = runs(shard)
    none = np.empty(0, np.uint8)
    out: dict[str, list] = {c: [] for c in ("shard", *_PARTS)}
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        order = np.argsort(owner[a:b], kind="stable")
        own = owner[a:b][order]
        at = runs(own)
        out["shard"].append(int(shard[a]))
        out["owner"].append(own[at[:-1]])
        out["size"].append(np.diff(at).astype(np.uint32))
        out["code"].append(code[a:b][order])
        out["extra"].append(extra[a:b][order] if extra is not None else none)
        out["note"].append(note[a:b][order][at[:-1]] if note is not None else none)
    if out["shard"]:
        yield pa.record_batch([pa.array(out["shard"], pa.int32()), *(packed(out[c]) for c in _PARTS)], schema=_CELL)


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of a partition sorted by ``key``, one key at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = runs(keys)
        for a, b in zip(at[:-1], at[1:], strict=True):
            if now is not None and keys[a] != now:
                yield now, held
                held = []
            now = keys[a]
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield now, held
    del held
    give_back()


def values(rows: list[pa.RecordBatch], name: str, kind) -> np.ndarray:
    """A packed column of some cells as one array; empty where there is none."""
    parts = [np.frombuffer(v.as_buffer(), kind) for r in rows if name in r.schema.names for v in r.column(name) if v.is_valid]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def unpack(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and code of each entry of some cells."""
    return np.repeat(values(rows, "owner", np.int64), values(rows, "size", np.uint32)), values(rows, "code", U64)
