"""N-gram Jaccard join: documents whose sets of word shingles overlap by 0.75 or more.

The method is a count-vector R-tree: a document's shingles are hashed into
groups and its group counts are a point; the summed coordinate minima of two
points, or of a point and a node's upper corner, bound the overlap from
above; pairs that survive are verified on the shingles themselves.

One tree over all documents cannot prune at its root: in 64 dimensions the
points of unrelated documents lie closer together than a node is wide. So the
root fans out by content. Shingles are counted over all documents (packed
cells, see ``cells``), and only those that another document has too stay in
play, since no other can be part of an overlap. A document with fewer than 75 %
of such shingles links with nothing. Any linked pair shares one of its first
``R - t + 1`` shingles, rarest first (``R`` shared shingles, ``t`` needed):
these name the root's children. Each child is a tree of its members' points.

Two rounds keep large groups cheap without losing a link. First every member
of a child is verified against the child's smallest member, its head, and
components are built. Then children with the same head become one, and only
those that still hold several components are joined through their trees, and
only across components: a task has its members' shingles, verifies its pairs
itself, and stops looking at two components once a link joins them, so it
sends fewer links than it has members. Copies count as one node (a signature
of the set), so groups of exact copies never meet in a join, and children of
more than ``TILE`` members are split into pairs of tiles.

Defined results: the words are those of the whole text, A-Z in lower case; a
text with fewer words than ``k`` is one shingle; a text without words, and a
null text, has an empty set and links with nothing; a null id links with
nothing and has a null component; rows that share an id are judged one by
one; an empty table gives an empty result; other columns are not needed.
A set's signature and its shingles are 64-bit codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakwatch.llm import cells as C
from leakwatch.llm.components import connected
from leakwatch.llm.textcodes import chunks, mix, text_windows, window_codes, word_codes

U64 = np.uint64
GROUPS = 64
LEAF = 16
TILE = 2048
TILE_CODES = 2_000_000
_SET = "id long, sig long, n_shingles long, text_code long"
_WHICH = np.dtype([("id", "<i8"), ("text", "<i8")])
_SEED = U64(0xA0761D6478BD642F)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle codes of each text sorted by (text, code), the text of
    each, the size of each text's set, and each set's signature."""
    words, first = word_codes(texts, lower=True)
    at, doc = text_windows(first, k)
    code = window_codes(words, k)[at]
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):  # the whole sequence as one shingle, told apart by its length
        whole = [window_codes(words[first[d] : first[d + 1]], int(count[d]))[0] ^ U64(count[d]) for d in few]
        doc, code = np.concatenate([doc, few]), np.concatenate([code, mix(np.array(whole, U64))])
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    doc, code = doc[new], code[new]
    size = np.bincount(doc, minlength=len(texts))
    sig = np.zeros(len(texts), U64)
    if len(code):
        at = C.runs(doc)[:-1]
        sig[doc[at]] = np.add.reduceat(mix(code ^ _SEED), at)
    return code, doc, size, mix(sig + size.astype(U64)).view(np.int64)


def _flush(held: list, shards: int) -> Iterator[pa.RecordBatch]:
    sig, code, n = (np.concatenate(x) for x in zip(*held, strict=True))
    held.clear()
    shard = C.shard_of(code, shards)
    order = np.argsort(shard, kind="stable")
    yield from C.cells(shard[order], sig[order], code[order], None, n[order])


def _shared(rows: list[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of a shard's shingles those that several sets have, with the number of sets, dealt by set."""
    sig, code = C.unpack(rows)
    n = np.repeat(C.values(rows, "note", np.uint32), C.values(rows, "size", np.uint32))
    order = np.lexsort((sig, code))
    sig, code, n = sig[order], code[order], n[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (sig[1:] != sig[:-1])
    sig, code, n = sig[new], code[new], n[new]
    at = C.runs(code)
    df = np.repeat(np.diff(at), np.diff(at)).astype(np.uint32)
    many = df > 1
    sig, code, n, df = sig[many], code[many], n[many], df[many]
    bucket = np.mod(sig, buckets).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    yield from C.cells(bucket[order], sig[order], code[order], df[order], n[order])


_NODE = "node long, n long, points binary, shared binary, keys array<long>"
_NODE_ARROW = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("points", pa.binary()), ("shared", pa.binary()), ("keys", pa.list_(pa.int64()))])


def _nodes(rows: list[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    """A bucket's sets that can link: point, shared shingles, root keys."""
    sig, code = C.unpack(rows)
    df = C.values(rows, "extra", np.uint32)
    n = np.repeat(C.values(rows, "note", np.uint32), C.values(rows, "size", np.uint32)).astype(np.int64)
    order = np.lexsort((code, sig))
    sig, code, df, n = sig[order], code[order], df[order], n[order]
    at = C.runs(sig)
    out: list[list] = [[], [], [], [], []]
    for a, b in zip(at[:-1], at[1:], strict=True):
        need = -(-percent * int(n[a]) // 100)
        if b - a < need:
            continue
        rare = np.lexsort((code[a:b], df[a:b]))[: b - a - need + 1]
        point = np.bincount((code[a:b] >> U64(20)).astype(np.int64) % GROUPS, minlength=GROUPS).astype(np.uint32)
        for column, value in zip(out, (int(sig[a]), int(n[a]), point.tobytes(), code[a:b].tobytes(), code[a:b][rare].view(np.int64)), strict=True):
            column.append(value)
    return pa.record_batch([pa.array(v, f.type) for v, f in zip(out, _NODE_ARROW, strict=True)], schema=_NODE_ARROW)


def needed(na, nb, percent: int):
    """Smallest overlap of two sets of these sizes that links them."""
    return -(-percent * (na + nb) // (100 + percent))


class CountTree:
    """R-tree of count points, packed bottom-up. Points are ordered by set
    size and then by coordinates; a node keeps its upper corner and its
    smallest and largest set size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        hi, least, most = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(hi, least, most)]
        while len(hi) > LEAF:
            at = np.arange(0, len(hi), LEAF)
            hi, least, most = np.maximum.reduceat(hi, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((hi, least, most))

    def search(self, points: np.ndarray, sizes: np.ndarray, percent: int, block: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) index pairs whose bound reaches the needed overlap."""
        top = len(self.levels[-1][0])
        for start in range(0, len(points), max(1, block // top)):
            q = np.arange(start, min(len(points), start + max(1, block // top)))
            stack = [(len(self.levels) - 1, np.repeat(q, top), np.tile(np.arange(top), len(q)))]
            while stack:
                level, q, node = stack.pop()
                if len(q) > block:
                    stack += [(level, q[i : i + block], node[i : i + block]) for i in range(0, len(q), block)]
                    continue
                hi, least, most = self.levels[level]
                fits = (100 * sizes[q] >= percent * least[node]) & (100 * most[node] >= percent * sizes[q])
                q, node = q[fits], node[fits]
                smaller = np.maximum(least[node], -(-percent * sizes[q] // 100))
                bound = np.minimum(points[q], hi[node]).sum(1)
                on = bound >= needed(sizes[q], smaller, percent)
                q, node = q[on], node[on]
                if not len(q):
                    continue
                if level == 0:
                    yield q, self.order[node]
                    continue
                first = node * LEAF
                width = np.minimum(first + LEAF, len(self.levels[level - 1][0])) - first
                child = np.repeat(first - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
                stack.append((level - 1, np.repeat(q, width), child))


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Codes that two sets of distinct codes share."""
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _tree_links(rows: list[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links across components among one child's members (or of two tiles of
    one), verified here: as soon as a link joins two components, no other pair
    of them is looked at, so fewer links leave than members came."""
    t = pa.Table.from_batches(rows)
    node, size, label, side = (t[c].to_numpy() for c in ("node", "n", "label", "side"))
    points = C.values(rows, "points", np.uint32).reshape(-1, GROUPS).astype(np.int64)
    codes = [np.frombuffer(v.as_buffer(), U64) for r in rows for v in r.column("shared")]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # 2: both, one tile with itself
    if not len(left) or not len(right):
        return
    group = np.unique(label, return_inverse=True)[1]
    root = np.arange(group.max() + 1)

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    def settle() -> None:
        while (root[root] != root).any():
            root[:] = root[root]

    out: tuple[list, list] = ([], [])
    tree = CountTree(points[right], size[right])
    for q, m in tree.search(points[left], size[left], percent):
        x, y = left[q], right[m]
        settle()
        on = (root[group[x]] != root[group[y]]) & ((side[x] != 2) | (node[x] < node[y]))
        for i, j in zip(x[on].tolist(), y[on].tolist(), strict=True):
            g, h = find(group[i]), find(group[j])
            if g != h and overlap(codes[i], codes[j]) >= needed(size[i], size[j], percent):
                root[max(g, h)] = min(g, h)
                out[0].append(min(node[i], node[j]))
                out[1].append(max(node[i], node[j]))
    if out[0]:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in out], schema=_PAIR)


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets overlap enough."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("points").alias(f"p{x}"), F.col("shared").alias(f"s{x}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            need = needed(na, nb, percent)
            pa_, pb = (C.values([batch], c, np.uint32).reshape(-1, GROUPS) for c in ("pa", "pb"))
            ok = np.minimum(pa_, pb).sum(1) >= need
            sa, sb = batch.column("sa"), batch.column("sb")
            for i in np.flatnonzero(ok):
                ok[i] = overlap(np.frombuffer(sa[i].as_buffer(), U64), np.frombuffer(sb[i].as_buffer(), U64)) >= need[i]
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long")


def link_sets(nodes: DataFrame, percent: int, n_parts: int) -> DataFrame:
    """(node, root) components of the sets that link."""
    members = nodes.select("node", "n", F.explode("keys").alias("key"))
    near = lambda a, b: (100 * F.least(a, b) >= percent * F.greatest(a, b))
    heads = members.groupBy("key").agg(F.count("*").alias("m"), F.min(F.struct("node", "n")).alias("head")).where("m > 1")
    # Children with the same head are one: any two sets that share a key share its head.
    child = members.join(heads, "key").select(F.col("head.node").alias("a"), F.col("head.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb"))
    child = child.distinct().checkpoint()
    stars = child.where((F.col("a") != F.col("b")) & near(F.col("na"), F.col("nb"))).select("a", "b")
    first = _verified(stars, nodes, percent).checkpoint()
    roots = connected(first)

    labelled = child.join(roots.withColumnRenamed("node", "b"), "b", "left").select("a", F.col("b").alias("node"), F.coalesce("root", "b").alias("label"), "nb")
    labelled = labelled.checkpoint()
    opened = labelled.groupBy("a").agg(F.count("*").alias("m"), F.sum("nb").alias("codes"), F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    # A tile has at most about TILE members and TILE_CODES codes.
    opened = opened.select("a", F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("codes") / TILE_CODES)).cast("int").alias("tiles")).checkpoint()
    mine = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    inside = labelled.join(opened, "a").withColumn("t", mine)
    # Tile t meets every tile u; the pair's smaller tile is side 0, the larger side 1.
    inside = inside.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("t") == F.col("u"), 2).when(F.col("t") < F.col("u"), 0).otherwise(1)
    task = F.xxhash64("a", F.least("t", "u"), F.greatest("t", "u"))
    inside = inside.select(task.alias("task"), "node", "label", side.cast("int").alias("side"))
    inside = inside.join(nodes.select("node", "n", "points", "shared"), "node").select("task", "node", "n", "label", "side", "points", "shared")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in C.by_key(batches, "task"):
            yield from _tree_links(rows, percent)

    second = C.deal(inside, "task", n_parts).mapInArrow(search, "a long, b long").distinct().checkpoint()
    return connected(first.union(second))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """(id_col, n_shingles, component_id) of every row of ``docs``."""
    return jaccard_groups(docs, id_col, text_col, k, percent).select(id_col, "n_shingles", "component_id")


def text_code(text: bytes | None) -> int:
    """What Spark's ``xxhash64`` gives for a text column."""
    code = 42 if text is None else xxhash.xxh64_intdigest(text, seed=42)
    return code - (1 << 64) if code >= 1 << 63 else code


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """As ``jaccard_components``, with ``root`` (the component, whatever its
    ids) and ``text_code``, which with the id tells the rows of ``docs`` apart."""
    spark = docs.sparkSession
    C.whole_batches(spark)
    n_parts = C.partitions(spark)
    size = C.text_bytes(docs, text_col)
    shards, buckets = C.shard_count(size / 5, n_parts), C.bucket_count(size, n_parts)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, seen = [], 0, set()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in chunks(texts):
                code, doc, count, sig = shingle_sets([t or b"" for t in texts[a:b]], k)
                # A cell of its own kind (negative shard) says which row has which set.
                known = pa.array(ids.slice(a, b - a)).fill_null(0).to_numpy(zero_copy_only=False)
                valid = ids.slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)
                shard = np.full(b - a, -1 - int(known[0]) % n_parts, np.int32)
                row = (np.arange(b - a)).astype(np.int64)
                which = np.empty(b - a, _WHICH)
                which["id"], which["text"] = known, [text_code(t) for t in texts[a:b]]
                yield from C.cells(shard, row, sig.view(U64), which, count.astype(np.uint32) * 2 + valid.astype(np.uint32))
                fresh = np.zeros(b - a, bool)
                for i in np.flatnonzero((count > 0) & valid):
                    if int(sig[i]) not in seen:
                        seen.add(int(sig[i]))
                        fresh[i] = True
                on = fresh[doc]
                held.append((sig[doc[on]], code[on], count[doc[on]].astype(np.uint32)))
                total += len(held[-1][0])
                if total >= C.CODES_PER_FLUSH:
                    yield from _flush(held, shards)
                    held, total, seen = [], 0, set()
                    C.give_back()
        if total:
            yield from _flush(held, shards)
        del held
        C.give_back()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in C.by_key(batches, "shard"):
            if shard < 0:
                for r in rows:
                    yield r
            else:
                yield from _shared(rows, buckets)

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = C.deal(source.mapInArrow(collect, C.CELL_SCHEMA), "shard", n_parts).mapInArrow(judge, C.CELL_SCHEMA).checkpoint()

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, sig, note = C.values([batch], "extra", _WHICH), C.values([batch], "code", np.int64), C.values([batch], "note", np.uint32)
            yield pa.record_batch([pa.array(which["id"], mask=note % 2 == 0), pa.array(sig), pa.array((note // 2).astype(np.int64)), pa.array(which["text"])], names=["id", "sig", "n_shingles", "text_code"])

    sets = found.where("shard < 0").mapInArrow(rows_of, _SET)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in C.by_key(batches, "shard"):
            yield _nodes(rows, percent)

    nodes = C.deal(found.where("shard >= 0"), "shard", n_parts).mapInArrow(build, _NODE).checkpoint()
    roots = link_sets(nodes, percent, n_parts)

    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    rooted = sets.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    # As tables of their own, so that a hot root can be split in the join.
    first = rooted.where(linked).groupBy("root").agg(F.min("id").alias("least")).checkpoint()
    component = F.when(linked, F.col("least")).otherwise(F.col("id"))
    return rooted.join(first, "root", "left").select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), "root", "text_code")


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of ``groups`` (``jaccard_groups``):
    that of the smallest id, and of its smallest text code if rows of one id
    belong to the component. Rows that share an id are judged one by one; of
    rows with one id and text one stays, the smallest in the order of its
    columns. Rows that link with nothing (no words, null id) all stay."""
    linked = groups.where((F.col("n_shingles") > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col("text_code").alias("_code"), "root")
    linked = linked.checkpoint()
    first = linked.groupBy("root").agg(F.min(F.struct("_id", "_code")).alias("first")).checkpoint()
    gone = linked.join(first, "root").where(F.struct("_id", "_code") != F.col("first")).select("_id", "_code").distinct()
    repeated = linked.groupBy("_id", "_code").agg(F.count("*").alias("n")).where("n > 1").select("_id", "_code").checkpoint()
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_code"), F.struct(*docs.columns).alias("_row"))
    kept = rows.join(gone, ["_id", "_code"], "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, ["_id", "_code"], "left_semi").groupBy("_id", "_code").agg(F.min("_row").alias("_row"))
        kept = kept.join(repeated, ["_id", "_code"], "left_anti").unionByName(once)
    return kept.select("_row.*")
