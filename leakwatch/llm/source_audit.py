"""Source divergence audit by chunk factorization.

Which words does a source of a language use more than the language does, and
how far are sources apart? Terms are counted without tokenizing any word
twice: a task counts the white-space chunks of each of its documents; every
globally distinct chunk is cut into terms once; the terms are joined back to
the chunks, and occurrences and distinct documents are added up. A term's
documents are at most those of its chunks together, so terms whose chunks do
not reach the bound need not be joined back: no result changes.

A document's chunks never cross the network one by one. Documents form
batches (``BATCH_BYTES`` of text). A batch sends one row per distinct chunk,
with the chunk's number in the batch, to the join with the terms; the counts
per document, as numbers, wait as one packed row per batch for the answers.
There (document, term) is made distinct, so a document that writes a term in
several ways counts once, and one row per (lang, source, term) leaves.

Distances between all sources of a language are sums over its kept terms.
Each term's shares are one array per tile of ``TILE`` sources, and a task adds
up the differences of two tiles, so only one row per pair of sources and
shard of terms leaves it.

All arithmetic is on integers: decimals for the shares, 64-bit sums of the
differences (each at most 10**9 + 1).

Defined results: null text, lang and source are empty strings; every row is a
document, also where ids repeat; documents without terms still name their
group; a language without kept terms has distance 0 between its sources; an
empty table gives an empty result; very long texts are counted in slices;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakwatch.llm import cells as C
from leakwatch.llm.tables import arrow_batches, drop, written
from leakwatch.llm.textcodes import mix

BATCH_BYTES = 32 << 20
#: A longer text is counted in slices that end at white space.
SLICE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TILE = 256
#: Bytes of a table that may be broadcast; a larger one is joined by key.
MAX_BROADCAST = 32 << 20
#: Kept terms of a language that one task adds up for two tiles.
TERMS_PER_SHARD = 4096

#: One row per batch (no chunk: its counts, packed) and one per distinct chunk of it.
_BATCH = "batch long, chunk string, number int, n_docs long, docs binary, chunks binary, counts binary, groups binary"
_BATCH_ARROW = pa.schema(
    [("batch", pa.int64()), ("chunk", pa.string()), ("number", pa.int32()), ("n_docs", pa.int64()), *((c, pa.binary()) for c in ("docs", "chunks", "counts", "groups"))]
)
_USE = "lang string, source string, term long, n long, n_docs long"


def _shrunk(values: np.ndarray) -> bytes:
    return pa.compress(values.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def _grown(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint32).astype(np.int64)


class Numbers(dict):
    """Numbers of chunks in the order of their first use."""

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = k = len(self)
        return k

    def of(self, text: bytes) -> np.ndarray:
        """The number of each white-space chunk of a text."""
        out, start = [np.empty(0, np.int64)], 0
        while start < len(text):
            cut = _SPACE.search(text, start + SLICE) if len(text) - start > SLICE else None
            stop = cut.start() if cut else len(text)
            words = text[start:stop].split()
            out.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
            start = stop + 1
        return np.concatenate(out)


class _Batch:
    """Chunks of some documents: their numbers, and counts per document."""

    def __init__(self):
        self.number, self.groups = Numbers(), {}
        self.group, self.size, self.chunk, self.count, self.held = [], [], [], [], []
        self.bytes = self.n_held = 0

    def add(self, text: bytes, lang: str, source: str) -> None:
        self.group.append(self.groups.setdefault((lang, source), len(self.groups)))
        self.held.append(self.number.of(text))
        self.n_held += len(self.held[-1])
        self.bytes += len(text)
        if self.n_held >= 1 << 18:
            self.compress()

    def compress(self) -> None:
        """Occurrences of the held documents become counts."""
        doc = np.repeat(np.arange(len(self.held)), [len(x) for x in self.held])
        key, count = np.unique(doc << 32 | np.concatenate([np.empty(0, np.int64), *self.held]), return_counts=True)
        self.size.append(np.bincount(key >> 32, minlength=len(self.held)).astype(np.uint32))
        self.chunk.append((key & 0xFFFFFFFF).astype(np.uint32))
        self.count.append(count.astype(np.uint32))
        self.held, self.n_held = [], 0

    def rows(self, batch: int) -> Iterator[pa.RecordBatch]:
        self.compress()
        docs = np.stack([np.array(self.group, np.uint32), np.concatenate(self.size)])
        chunk = np.concatenate(self.chunk)
        # A document's chunks ascend: their differences are small numbers.
        gap = np.diff(chunk, prepend=chunk[:1] * 0)
        starts = np.cumsum(docs[1]) - docs[1]
        starts = starts[docs[1] > 0]
        gap[starts] = chunk[starts]
        packed = [docs.tobytes(), _shrunk(gap), _shrunk(np.concatenate(self.count)), json.dumps(list(self.groups)).encode()]
        batch = int(mix(np.array([batch], np.uint64)).view(np.int64)[0])
        yield pa.record_batch([[batch], [None], [None], [None], *([x] for x in packed)], schema=_BATCH_ARROW)
        n_docs = np.bincount(chunk, minlength=len(self.number))
        words = list(self.number)
        for i in range(0, len(words), 1 << 14):
            part = words[i : i + (1 << 14)]
            none = [pa.nulls(len(part), pa.binary())] * 4
            head = [np.full(len(part), batch), pa.array(part, pa.binary()).cast(pa.string()), np.arange(i, i + len(part), dtype=np.int32)]
            yield pa.record_batch([pa.array(x) for x in (*head, n_docs[i : i + len(part)])] + none, schema=_BATCH_ARROW)


def _count(batches: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_BATCH`` of a partition's (text, lang, source, part)."""
    now, n = _Batch(), 0
    for rows in batches:
        for text, lang, source, part in zip(rows.column("text").cast(pa.binary()), *(rows.column(c).to_pylist() for c in ("lang", "source", "part")), strict=True):
            now.add(text.as_py(), lang, source)
            if now.bytes >= batch_bytes:
                yield from now.rows(part << 33 | n)
                now, n = _Batch(), n + 1
    if now.group:
        yield from now.rows(part << 33 | n)
    del now
    C.give_back()


def _use(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uses of each (lang, source, term) in one batch."""
    t = pa.Table.from_batches(rows)
    head = t.filter(t.column("docs").is_valid()).to_pylist()[0]
    t = t.filter(t.column("docs").is_null())
    if not t.num_rows:
        return
    chunk_of = t.column("number").to_numpy()
    terms, term = np.unique(t.column("term").to_numpy(), return_inverse=True)
    group, size = np.frombuffer(head["docs"], np.uint32).reshape(2, -1).astype(np.int64)
    doc = np.repeat(np.arange(len(size)), size)
    total = np.cumsum(_grown(head["chunks"], len(doc)))
    before = np.cumsum(size) - size
    chunk = total - np.repeat(np.concatenate([[0], total])[before], size)
    count = _grown(head["counts"], len(doc))
    n_chunks = int(max(chunk.max(), chunk_of.max())) + 1
    order = np.argsort(chunk_of, kind="stable")
    term = term[order]
    width = np.bincount(chunk_of, minlength=n_chunks)
    start = np.cumsum(width) - width
    n_terms = len(terms)
    bounds = np.searchsorted(doc, np.arange(0, len(size) + 1024, 1024))
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):  # some documents at a time
        w = width[chunk[a:b]]
        ends = np.cumsum(w)
        at = np.repeat(start[chunk[a:b]] - (ends - w), w) + np.arange(ends[-1] if len(ends) else 0)
        key = np.repeat(doc[a:b], w) * n_terms + term[at]
        order = np.argsort(key, kind="stable")
        key, n = key[order], np.repeat(count[a:b], w)[order]
        runs = C.runs(key)[:-1]
        if len(key):
            key, n = key[runs], np.add.reduceat(n, runs)
            found.append((group[key // n_terms] * n_terms + key % n_terms, n))
    if not found:
        return
    key, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    runs = C.runs(key)
    key, n, n_docs = key[runs[:-1]], np.add.reduceat(n, runs[:-1]), np.diff(runs)
    langs, sources = (pa.array(x, pa.string()) for x in zip(*json.loads(head["groups"]), strict=True))
    g = pa.array(key // n_terms)
    columns = [langs.take(g), sources.take(g), pa.array(terms[key % n_terms]), pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())]
    out = pa.record_batch(columns, names=["lang", "source", "term", "n", "n_docs"])
    for i in range(0, out.num_rows, 1 << 15):
        yield out.slice(i, 1 << 15)


def _clean(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _small(df: DataFrame, length: Column, most: int) -> Callable[[DataFrame], DataFrame]:
    """``F.broadcast`` if the rows, of ``length`` bytes and some 50 more each, have at most ``most`` bytes."""
    size = df.agg(F.sum(length.cast("long") + 50)).first()[0] or 0
    return F.broadcast if size <= most else lambda x: x


def chunk_terms(chunks: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(chunk, term): a row for each occurrence of a term in a distinct chunk,
    for the terms that ``min_docs`` documents may have; and (term, name) of these."""
    lower = F.translate("chunk", UPPER, LOWER)
    cut = chunks.groupBy("chunk").agg(F.sum("n_docs").alias("n_docs"))
    cut = cut.withColumn("names", F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).where(F.size("names") > 0)
    cut = written(cut, "chunk_terms", "zstd", dictionary=False)
    bound = cut.select(F.explode(F.array_distinct("names")).alias("name"), "n_docs").groupBy("name").agg(F.sum("n_docs").alias("n"))
    likely = written(bound.where(F.col("n") >= min_docs).select(F.monotonically_increasing_id().alias("term"), "name"), "likely_terms")
    small = _small(likely, F.octet_length("name"), MAX_BROADCAST)
    terms = written(cut.select("chunk", F.explode("names").alias("name")).join(small(likely), "name").select("chunk", "term"), "terms", "zstd")
    drop(cut)
    return terms, likely


def term_use(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 1) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, n_docs): occurrences and documents of every
    term of at least ``min_docs`` documents of a language (and of some others,
    which have fewer); and (term, name)."""
    spark = docs.sparkSession
    source = docs.select(_clean(text_col).alias("text"), _clean(lang_col).alias("lang"), _clean(source_col).alias("source"), F.spark_partition_id().alias("part"))
    batch_bytes = BATCH_BYTES

    def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in C.by_key(batches, "batch"):
            yield from _use(rows)

    with arrow_batches(spark, rows=4096, size=4 << 20):
        counted = written(source.mapInArrow(lambda b: _count(b, batch_bytes), _BATCH), "chunk_counts", "zstd", dictionary=False)
        chunks = counted.where("chunk is not null")
        terms, names = chunk_terms(chunks, min_docs)
        back = chunks.select("chunk", "batch", "number").join(terms, "chunk").select("batch", "number", "term")
        packed = counted.where("chunk is null").select("batch", "docs", "chunks", "counts", "groups")
        both = back.unionByName(packed, allowMissingColumns=True)
        used = C.deal(both, "batch", C.partitions(spark)).mapInArrow(use, _USE)
        used = written(used.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "term_use")
    drop(counted)
    drop(terms)
    return used, names


def share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(10**9 (count + 5) / (total + 5 n_terms)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (wide(count) + 5)
    return F.call_function("div", top, (wide(total) + wide(n_terms) * 5).cast("decimal(25,0)")) + 1


def _distances(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Summed differences between the sources of two tiles of ``size`` over a shard of terms."""
    for _, rows in C.by_key(batches, "task"):
        t = pa.Table.from_batches(rows)
        lang, a, b = (t.column(c)[0].as_py() for c in ("lang", "a", "b"))
        # Rows come sorted by term and tile: both tiles of a term follow each other.
        tile = t.column("tile").to_numpy()
        flat = [np.stack(t.filter(pa.array(tile == x)).column("shares").combine_chunks().to_numpy(zero_copy_only=False)) for x in (a, b)]
        out = np.zeros((flat[0].shape[1], flat[1].shape[1]), np.int64)
        for p, q in zip(*flat, strict=True):
            out += np.abs(p[:, None] - q[None, :])
        i, j = (x.ravel() for x in np.indices(out.shape))
        yield pa.record_batch([pa.array([lang] * len(i)), pa.array(i + a * size, pa.int64()), pa.array(j + b * size, pa.int64()), pa.array(out.ravel())], names=["lang", "i", "j", "value"])


def _pairs(kept: DataFrame, used: DataFrame, groups: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language."""
    at = groups.select("lang", "number", "source")
    tiles = groups.groupBy("lang", F.expr(f"number div {TILE}").alias("tile")).agg(F.sort_array(F.collect_list(F.struct("number", "total"))).alias("members"), F.first("n_terms").alias("n_terms"), F.first(F.expr(f"(n_sources - 1) div {TILE} + 1")).alias("n_tiles"))
    tile_of = used.join(small(at), ["lang", "source"]).groupBy("lang", "term", F.expr(f"number div {TILE}").alias("tile")).agg(F.map_from_entries(F.collect_list(F.struct("number", "n"))).alias("counts"))
    every = kept.select("lang", "term").join(small(tiles), "lang").join(tile_of, ["lang", "term", "tile"], "left")
    count = lambda m: F.coalesce(F.try_element_at("counts", m["number"]), F.lit(0).cast("long"))
    every = every.withColumn("shares", F.transform("members", lambda m: share(count(m), m["total"], F.col("n_terms"))))
    shard = F.pmod(F.xxhash64("term"), F.ceil(F.col("n_terms") / TERMS_PER_SHARD)).alias("shard")
    with_tiles = every.select("lang", "term", "tile", "shares", shard, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tiles") - 1)).alias("other"))
    a, b = F.least("tile", "other"), F.greatest("tile", "other")
    task = F.xxhash64("lang", "shard", a, b)
    tasks = with_tiles.select(task.alias("task"), "lang", "term", "tile", a.alias("a"), b.alias("b"), "shares")
    dealt = C.deal(tasks, "task", C.partitions(kept.sparkSession), "lang", "term", "tile")
    size = TILE
    one_way = dealt.mapInArrow(lambda b: _distances(b, size), "lang string, i long, j long, value long")
    summed = one_way.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    # A tile meets another one once, and itself in both directions.
    other = summed.where(f"i div {TILE} <> j div {TILE}").select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value")
    named = summed.union(other).where("i <> j")
    left, right = at.toDF("lang", "i", "source"), at.toDF("lang", "j", "item")
    return named.join(small(left), ["lang", "i"]).join(small(right), ["lang", "j"]).select("lang", "source", "item", "value")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair``, the distance to
    every other source of the language; ``term``, the ``top`` terms that the
    source uses more than its language."""
    used, names = term_use(docs, text_col, lang_col, source_col, min_docs)
    kept = used.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= min_docs).drop("n_docs").checkpoint()
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    used = written(used.join(kept, ["lang", "term"]), "kept_use")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = docs.select(_clean(lang_col).alias("lang"), _clean(source_col).alias("source")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = found.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", zero("total"), zero("n_terms"), zero("lang_total"), number.alias("number"), F.count("*").over(Window.partitionBy("lang")).alias("n_sources")).checkpoint()
    small = _small(groups, F.octet_length("lang") + F.octet_length("source"), MAX_BROADCAST)

    p, q = share(F.col("n"), F.col("total"), F.col("n_terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    terms = used.join(small(groups), ["lang", "source"]).withColumn("value", p - q).where("value > 0")
    terms = terms.join(names, "term").select("lang", "source", F.col("name").alias("item"), "value")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)

    # Languages without kept terms have no rows to add up: their sources are 0 apart.
    bare = groups.where("n_terms = 0")
    apart = bare.alias("x").join(bare.alias("y"), (F.col("x.lang") == F.col("y.lang")) & (F.col("x.source") != F.col("y.source")))
    apart = apart.select("x.lang", "x.source", F.col("y.source").alias("item"), F.lit(0).cast("long").alias("value"))
    pairs = _pairs(kept, used, groups, small).union(apart).withColumn("rank", F.row_number().over(by))
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pairs, "pair").union(part(terms, "term"))
