"""Substring dedup: cut passages that already stand in an earlier document.

Every window of ``window`` consecutive words gets a Rabin-Karp code; the
windows of all documents meet by code in packed cells, and a window is
repeated if its words also start in a document with a smaller id. A
document's repeated windows merge into maximal intervals of words, which are
removed. Windows are judged on the input, not on what is left of it.

Hot passages: a task keeps each code once, with the smallest id it has seen,
so a passage that stands in a third of all documents is one entry per task
batch in the exchange. The other documents of the batch are decided there
and then. Codes compare by 64 bits plus 16 bits of a second polynomial.

Defined results: a null or empty text has no words and nothing to remove; a
document with fewer words than ``window`` keeps them all; a null id neither
removes nor is removed from; rows that share an id do not remove each other;
an empty table gives an empty result; other columns pass through, also when
they are named like the columns added (then they are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.llm import cells as C
from leakwatch.llm.textcodes import BASE, CHECK_BASE, chunks, text_windows, window_codes, word_codes

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField(
            "removed",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])),
        ),
    ]
)


def _entries(ids: np.ndarray, texts: list[bytes], window: int):
    words, first = word_codes(texts)
    at, doc = text_windows(first, window)
    check = (window_codes(words, window, CHECK_BASE) >> np.uint64(48)).astype(np.uint16)
    return ids[doc], window_codes(words, window, BASE)[at], check[at]


def _grouped(doc: np.ndarray, code: np.ndarray, check: np.ndarray):
    """Entries sorted by code (and check, where codes alone collide) and in a
    group by document, so that its first one has the smallest; the start of
    each group; and which entries have a smaller document in their group."""
    if (doc[1:] < doc[:-1]).any():
        order = np.argsort(doc, kind="stable")
        doc, code, check = doc[order], code[order], check[order]
        del order
    order = np.argsort(code, kind="stable")
    code, check = code[order], check[order]
    same = code[1:] == code[:-1]
    if (same & (check[1:] != check[:-1])).any():
        back = np.lexsort((order, check, code))
        order, code, check = order[back], code[back], check[back]
    doc = doc[order]
    del order, same
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (check[1:] != check[:-1])
    start = np.flatnonzero(new)
    late = doc != np.repeat(doc[start], np.diff(np.append(start, len(code))))
    return doc, code, check, start, late


def _decided(doc: np.ndarray, code: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Cells of repeated windows, keyed by the bucket of their document."""
    bucket = np.mod(doc, buckets).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    yield from C.cells(bucket[order], doc[order], code[order])


def _flush(held: list, shards: int, buckets: int) -> Iterator[pa.RecordBatch]:
    doc, code, check = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    doc, code, check, rep, late = _grouped(doc, code, check)
    for batch in _decided(doc[late], code[late], buckets):  # negative shards: already decided
        yield pa.RecordBatch.from_arrays([pa.array(-1 - batch.column(0).to_numpy(), pa.int32()), *batch.columns[1:]], schema=batch.schema)
    yield from C.cells(C.shard_of(code[rep], shards), doc[rep], code[rep], check[rep])


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int, shards: int, buckets: int, n: int) -> DataFrame:
    """Cells (bucket, owner, size, code, extra) of the windows to remove."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in chunks(texts):
                held.append(_entries(ids[a:b], texts[a:b], window))
                size += len(held[-1][0])
                if size >= C.CODES_PER_FLUSH:
                    yield from _flush(held, shards, buckets)
                    held, size = [], 0
                    C.give_back()
        if size:
            yield from _flush(held, shards, buckets)
        del held
        C.give_back()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in C.by_key(batches, "shard"):
            doc, code = C.unpack(rows)
            check = C.values(rows, "extra", np.uint16)
            if shard >= 0:
                doc, code, _, _, late = _grouped(doc, code, check)
                doc, code = doc[late], code[late]
            del check, rows
            yield from _decided(doc, code, buckets)
            C.give_back()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).na.drop()
    found = C.deal(source.mapInArrow(collect, C.CELL_SCHEMA), "shard", n).mapInArrow(judge, C.CELL_SCHEMA)
    return found.withColumnRenamed("shard", "bucket")


def intervals(flag: np.ndarray, window: int) -> np.ndarray:
    """Maximal [start, stop) word intervals covered by windows that start at the flagged indexes."""
    at = np.flatnonzero(flag)
    if not len(at):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.diff(at) > window) + 1
    return np.stack([at[np.concatenate([[0], new])], at[np.concatenate([new - 1, [len(at) - 1]])] + window], 1)


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """``docs`` with ``text_col`` cut down to the words that are kept (joined
    by one space) and columns ``n_words``, ``n_removed`` and ``removed``, the
    maximal intervals [start, stop) of removed words."""
    spark = docs.sparkSession
    C.whole_batches(spark)
    docs = docs.drop(*[f.name for f in ADDED])
    n = C.partitions(spark)
    size = C.text_bytes(docs, text_col)
    shards, buckets = C.shard_count(size / 5, n), C.bucket_count(size, n)
    found = repeated_windows(docs, id_col, text_col, window, shards, buckets, n).checkpoint()

    key = F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(buckets)).cast("int")
    rows = docs.select(
        key.alias("bucket"), F.lit(True).alias("is_doc"), F.struct(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).alias("src"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"),
    )
    rows = rows.withColumns({c: F.lit(None).cast("binary") for c in ("owner", "size", "code")})
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("src", "doc")]
    cuts = found.select("bucket", F.lit(False).alias("is_doc"), *none, "owner", "size", "code")
    names = ["bucket", "is_doc", "src", "doc", "owner", "size", "code"]
    met = C.deal(rows.select(*names).unionByName(cuts), "bucket", n, "is_doc").select("bucket", "is_doc", "src", "doc", "owner", "size", "code")
    out_schema = T.StructType([rows.schema["doc"], T.StructField("cut", T.StringType()), *ADDED])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, table = None, [], (np.empty(0, np.int64), np.empty(0, np.uint64))
        for batch in batches:
            keys = batch.column("bucket").to_numpy()
            at = C.runs(keys)
            for a, b in zip(at[:-1], at[1:], strict=True):
                part = batch.slice(int(a), int(b - a))
                if keys[a] != now:
                    now, held, table = keys[a], [], (np.empty(0, np.int64), np.empty(0, np.uint64))
                is_doc = part.column("is_doc").to_numpy(zero_copy_only=False)
                k = int(np.argmax(is_doc)) if is_doc.any() else len(is_doc)
                if k:
                    held.append(C.unpack([part.slice(0, k)]))
                if k < len(is_doc):
                    if held:
                        if len(table[0]):
                            held.append(table)
                        owner, code = (np.concatenate(x) for x in zip(*held, strict=True))
                        order = np.argsort(owner, kind="stable")
                        held, table = [], (owner[order], code[order])
                    yield from _cut_rows(part.slice(k), table, window)
        del held, table
        C.give_back()

    wide = met.mapInArrow(cut, out_schema)
    keep = [F.col("cut").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns]
    return wide.select(*keep, *[f.name for f in ADDED])


def _cut_rows(part: pa.RecordBatch, table: tuple[np.ndarray, np.ndarray], window: int) -> Iterator[pa.RecordBatch]:
    src = part.column("src")
    ids, raw = src.field("id").to_pylist(), src.field("text").cast(pa.binary()).to_pylist()
    for a, b in chunks(raw):
        texts = [t or b"" for t in raw[a:b]]
        words, first = word_codes(texts)
        codes = window_codes(words, window)
        cut, total, removed, spans = [], np.diff(first), [], []
        for k, text in enumerate(texts):
            lo, hi = (np.searchsorted(table[0], ids[a + k], s) for s in ("left", "right")) if ids[a + k] is not None else (0, 0)
            split = text.split()
            span = np.empty((0, 2), np.int64)
            if hi > lo and total[k] >= window:
                span = intervals(np.isin(codes[first[k] : first[k + 1] - window + 1], table[1][lo:hi]), window)
                keep, done = [], 0
                for x, y in span.tolist():
                    keep += split[done:x]
                    done = y
                split = keep + split[done:]
            cut.append(None if raw[a + k] is None else b" ".join(split))
            removed.append(int((span[:, 1] - span[:, 0]).sum()))
            spans.append([{"start": x, "stop": y} for x, y in span.tolist()])
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc").slice(a, b - a), pa.array(cut, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span_type)],
            names=["doc", "cut", "n_words", "n_removed", "removed"],
        )
