"""Near-duplicate embeddings by product quantisation.

Vectors are put on the unit sphere, where a cosine of at least ``cos`` is a
distance of at most ``r = sqrt(2 - 2 cos)``. Coarse centroids split space into
inverted lists; inside a list a vector's residual is coded by the nearest
codeword of each subspace. The index is fitted on ``sample_rows`` vectors
(those with the smallest hash of their id) and holds every vector.

A vector probes every list that can hold a partner: its distance to the plane
halfway between its own and another centroid is what a partner must cross. If
that is more than ``r``, no vector of the list is in reach, and no link is
missed. If partners' offsets are alike in all directions, one of them is about
``r / sqrt(dimensions)``, and ``deviations`` times that reaches nearly all with
fewer probes; of skewed vectors it misses up to some hundredths.

Lists that follow one another stand on a shelf; a shelf holds about half a
tile of the largest label, so a vector is sent once a shelf that it probes,
not once a list. On a shelf, table look-ups give the product of the query with
the coded vectors: one row of products per codeword and one per centroid, added
up in whole numbers for a block of entries and all queries of a batch. As the coded vector is a
known error away from the real one, a distance above ``r`` plus that error rules
a vector out without fail, and the rest are ranked by exact cosine in double
precision. Never is a pair below ``cos`` linked.

Vectors with no clusters (independent, in many dimensions) have all lists in
reach, as no plane lies further from them than ``r``: the pairs of a label are
then all looked up, a few nanoseconds each, and a vector is sent about
``label rows / TILE`` times.

Equal vectors of a label are one entry with a weight, so a vector that a
third of the rows share costs nothing; fuller shelves are split into tiles of
``TILE`` entries, queries come to a tile in batches. A batch gives each
vector's links and the root of its component in the batch, never the pairs.

Defined results: a vector that is null, zero, or has null or non-finite
components, a null label and a null id link with nothing (0 links; the
component is the id itself); vectors of different length do not link; an
empty table gives an empty result; rows that share an id are judged one by
one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.llm import cells as C
from leakwatch.llm.components import connected

TILE = 32_768
#: Most numbers of a tile's vectors, whatever their length.
TILE_VALUES = 1 << 21
#: Queries of a batch, and entries that they are looked up against at once.
QUERY_BLOCK = 1024
ENTRY_BLOCK = 128
CODE_BLOCK = 256
#: Most planes between lists that a batch of queries is held against.
PLANES = 1 << 20
SUBSPACES = 8
CODEWORDS = 64
MAX_LISTS = 4096
SAMPLE_ROWS = 16_384
#: Allowance for rounding in the two bounds; the rerank itself is exact.
SLACK = 1e-6
#: The same for sums of single-precision products.
LOOKUP_SLACK = 1e-4
#: Products are looked up as whole numbers, their sum at most so large.
WHOLE = 16_000


@dataclass
class Index:
    centroids: np.ndarray  # lists x width
    codewords: np.ndarray  # subspaces x codewords x width / subspaces
    reach: float
    #: How far from a plane between two lists the list behind it is probed.
    margin: float
    #: Shelf of each list, ascending.
    shelf: np.ndarray

    @property
    def width(self) -> int:
        return self.centroids.shape[1]


def tile_of(width: int) -> int:
    return max(1, min(TILE, TILE_VALUES // width))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids of a bounded sample."""
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        on = n > 0
        c[on] = sums[on] / n[on, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * x @ c.T).argmin(1)


def unit(vectors: list, width: int) -> np.ndarray:
    """Unit vectors in double precision, padded with zeros to ``width``."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return scaled(out)


def scaled(x: np.ndarray) -> np.ndarray:
    """The rows brought to length 1."""
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow, no underflow in the square
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def padded(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Vectors without nulls as rows, padded with zeros to ``width``."""
    length = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width))
    out[np.arange(width)[None] < length[:, None]] = vectors.flatten().to_numpy()
    return out


def fit(sample: list, n_rows: int, cos: float, deviations: float | None = None, longest: int = 1, largest: int = 0) -> Index:
    """``longest``: entries of the longest vector of all, sampled or not;
    ``largest``: rows of the largest label."""
    width = -(-max((len(v) for v in sample), default=1) // SUBSPACES) * SUBSPACES
    width = max(width, -(-longest // SUBSPACES) * SUBSPACES)
    x = unit(sample, width) if sample else np.zeros((1, width))
    lists = int(min(MAX_LISTS, max(1, sqrt(n_rows) / 2), len(x)))
    c = k_means(x, lists)
    near = _nearest(x, c)
    rest = x - c[near]
    step = width // SUBSPACES
    words = [k_means(rest[:, i * step : (i + 1) * step], min(CODEWORDS, len(x)), seed=11 + i) for i in range(SUBSPACES)]
    reach = sqrt(max(0.0, 2 - 2 * cos))
    margin = reach if deviations is None else reach * min(1.0, deviations / sqrt(min((len(v) for v in sample), default=width)))
    shelves = min(lists, max(1, ceil(2 * largest / tile_of(width))))
    before = np.cumsum(np.bincount(near, minlength=lists)) - 1
    return Index(c, np.stack(words), reach, margin, before * shelves // len(x))


def encode(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home list, codes and coding error of unit vectors."""
    home = _nearest(x, index.centroids)
    rest = x - index.centroids[home]
    step = index.width // SUBSPACES
    code = np.empty((len(x), SUBSPACES), np.uint8)
    error = np.zeros(len(x))
    for m in range(SUBSPACES):
        part, words = rest[:, m * step : (m + 1) * step], index.codewords[m]
        code[:, m] = _nearest(part, words)
        error += ((part - words[code[:, m]]) ** 2).sum(1)
    return home, code, np.sqrt(error)


def in_reach(x: np.ndarray, home: np.ndarray, index: Index, first: int = 0, last: int | None = None) -> np.ndarray:
    """Which of the lists ``first`` to ``last`` each vector probes: every list
    up to its own that can hold a partner. A pair in two lists is found from
    the vector in the later one."""
    c, own = index.centroids[first:last], index.centroids[home]
    norm, own_norm = (c * c).sum(1)[None], (own * own).sum(1)[:, None]
    away = norm - own_norm - 2 * (x @ c.T - (x * own).sum(1)[:, None])
    # Rounding of the square stays below the addend, so no plane seems nearer than it is.
    apart = np.sqrt(np.maximum(own_norm + norm - 2 * own @ c.T, 0) + 1e-14)
    at = np.arange(first, first + len(c))[None]
    return (at == home[:, None]) | ((at < home[:, None]) & (away <= 2 * apart * (index.margin + SLACK)))


def probes(x: np.ndarray, home: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(vector, list) for every list that a vector probes."""
    return np.nonzero(in_reach(x, home, index))


def products(q: np.ndarray, index: Index) -> list[np.ndarray]:
    """For each subspace a table of the codewords' products with the queries."""
    step = index.width // SUBSPACES
    return [(index.codewords[m] @ q[:, m * step : (m + 1) * step].T).astype(np.float32) for m in range(SUBSPACES)]


def looked_up(tables: list[np.ndarray], ofs: list[np.ndarray]) -> np.ndarray:
    """Products of coded vectors (rows) and queries: one table row each, added up."""
    out = np.take(tables[0], ofs[0], axis=0, mode="clip")
    row = np.empty_like(out)
    for table, of in zip(tables[1:], ofs[1:], strict=True):
        out += np.take(table, of, axis=0, out=row, mode="clip")
    return out


def decoded(lists: np.ndarray, codes: np.ndarray, index: Index) -> np.ndarray:
    return index.centroids[lists] + np.concatenate([index.codewords[m][codes[:, m]] for m in range(SUBSPACES)], 1)


def lookup_distances(q: np.ndarray, lst: int, codes: np.ndarray, index: Index) -> np.ndarray:
    """Distance of each query to each coded vector of a list, from one table per subspace."""
    lists = np.full(len(codes), lst)
    centre = (index.centroids @ q.T).astype(np.float32)
    dot = looked_up([centre, *products(q, index)], [lists, *codes.T.astype(np.intp)]).T
    norm = (decoded(lists, codes, index) ** 2).sum(1)
    return np.sqrt(np.maximum((q * q).sum(1)[:, None] + norm[None] - 2 * dot, 0))


def roots_of(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of the component of each of ``n`` nodes, from edges."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


_CODED = "label long, size int, list int, shelf int, probed array<int>, id long, weight long, vector binary, code binary, error double"
_CODED_ARROW = pa.schema(
    [("label", pa.int64()), ("size", pa.int32()), ("list", pa.int32()), ("shelf", pa.int32()), ("probed", pa.list_(pa.int32())), ("id", pa.int64()), ("weight", pa.int64()), ("vector", pa.binary()), ("code", pa.binary()), ("error", pa.float64())]
)
_FOUND = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _coded(batch: pa.RecordBatch, index: Index, kind: type) -> Iterator[pa.RecordBatch]:
    """An entry's list, code, and the shelves that it probes."""
    raw = padded(batch.column("vector"), index.width)
    x = scaled(raw)
    home, code, error = encode(x, index)
    starts = np.flatnonzero(np.diff(index.shelf, prepend=-1))
    row, shelf = np.nonzero(np.logical_or.reduceat(in_reach(x, home, index), starts, axis=1))
    bounds = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
    probed = pa.ListArray.from_arrays(pa.array(bounds), pa.array(index.shelf[starts][shelf].astype(np.int32)))
    yield pa.record_batch(
        [
            batch.column("label"), batch.column("size"), pa.array(home.astype(np.int32)), pa.array(index.shelf[home].astype(np.int32)), probed,
            batch.column("id"), batch.column("weight"), C.sliced(raw.astype(kind).ravel(), np.arange(len(x) + 1) * index.width),
            C.sliced(code.ravel(), np.arange(len(x) + 1) * SUBSPACES), pa.array(error),
        ],
        schema=_CODED_ARROW,
    )


def _tile(parts: list[dict], index: Index) -> dict:
    """Entries of a tile by list, with the least product that leaves each in reach."""
    base = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    order = np.argsort(base["list"], kind="stable")
    base = {k: v[order] for k, v in base.items()}
    norm = (decoded(base["list"], base["code"], index) ** 2).sum(1)
    least = (1 + norm - (index.reach + SLACK + base["error"]) ** 2) / 2 - LOOKUP_SLACK
    return base | {"least": least, "code": base["code"].T.astype(np.intp)}


def _linked(base: dict, q: dict, index: Index, cos: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (query, entry) of the links between a batch of queries and a tile."""
    first, last = int(base["list"][0]), int(base["list"][-1]) + 1
    near = in_reach(q["vector"], q["list"], index, first, last)
    centre = (index.centroids[first:last] @ q["vector"].T).astype(np.float32)
    tables = [centre, *products(q["vector"], index)]
    scale = WHOLE / max(sum(float(np.abs(t).max()) for t in tables), 1e-30)
    tables = [np.rint(t * scale).astype(np.int16) for t in tables]
    # Each product is rounded by a half at most.
    least = np.clip(np.floor(base["least"] * scale) - len(tables), -2 * WHOLE, 2 * WHOLE).astype(np.int16)[:, None]
    for s in range(0, len(least), ENTRY_BLOCK):
        e = slice(s, s + ENTRY_BLOCK)
        lists = base["list"][e] - first
        on = np.flatnonzero(near[:, lists[0] : lists[-1] + 1].any(1))
        if 2 * len(on) > len(near):
            on, some = np.arange(len(near)), tables
        else:
            some = [t[:, on] for t in tables]
        if not len(on):
            continue
        j, i = np.divmod(np.flatnonzero(looked_up(some, [lists, *base["code"][:, e]]) >= least[e]), len(on))
        dense = 8 * len(i) > len(on) * len(lists)
        i, hit = on[i], near[on[i], lists[j]]
        j = j + s
        hit &= (q["label"][i] == base["label"][j]) & (q["size"][i] == base["size"][j]) & (q["id"][i] != base["id"][j])
        # In its own list a pair is looked at once.
        hit &= (q["list"][i] != base["list"][j]) | (q["id"][i] < base["id"][j])
        i, j = i[hit], j[hit]
        if dense:
            cosine = (q["vector"] @ base["vector"][e].T)[i, j - s]
        else:
            cosine = np.einsum("nd,nd->n", q["vector"][i], base["vector"][j])
        yield i[cosine >= cos], j[cosine >= cos]


def _search(base: dict, query: dict, index: Index, cos: float) -> Iterator[pa.RecordBatch]:
    """Links between the entries of a tile and a batch of queries."""
    lists = int(base["list"][-1] - base["list"][0]) + 1
    step = max(1, min(QUERY_BLOCK, PLANES // lists))
    for s in range(0, len(query["id"]), step):
        q = {k: v[s : s + step] for k, v in query.items()}
        found = list(_linked(base, q, index, cos))
        i, j = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
        if len(i):
            nodes, at = np.unique(np.concatenate([q["id"], base["id"]]), return_inverse=True)
            a, b = at[i], at[len(q["id"]) + j]
            links = np.zeros(len(nodes), np.int64)
            np.add.at(links, a, base["weight"][j])
            np.add.at(links, b, q["weight"][i])
            on = links > 0
            yield pa.record_batch([pa.array(nodes[on]), pa.array(links[on]), pa.array(nodes[roots_of(a, b, len(nodes))][on])], schema=_FOUND)


def _columns(batch: pa.RecordBatch, index: Index, kind: type) -> dict[str, np.ndarray]:
    out = {c: batch.column(c).to_numpy() for c in ("label", "size", "list", "id", "weight", "error")}
    out["vector"] = scaled(C.values([batch], "vector", kind).reshape(-1, index.width).astype(np.float64))
    out["code"] = C.values([batch], "code", np.uint8).reshape(-1, SUBSPACES)
    return out


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cos: float = 0.93,
    sample_rows: int = SAMPLE_ROWS,
    deviations: float | None = None,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    C.whole_batches(spark, QUERY_BLOCK)
    n = C.partitions(spark)
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType(), vectors.schema[vector_col].dataType.containsNull)
    kind = np.float32 if single else np.float64
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False))
    usable = F.coalesce(sound & F.exists("vector", lambda v: v != 0), F.lit(False))
    entries = rows.where(usable).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("weight")).checkpoint()
    picked = entries.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()  # bounded by sample_rows
    entries = entries.withColumn("size", F.size("vector"))
    labels = entries.groupBy("label", "size").agg(F.count("*").alias("m"), F.max("weight").alias("weight"))
    size, longest, largest, copies = labels.agg(F.sum("m"), F.max("size"), F.max("m"), F.max("weight")).first()
    index = fit(picked["vector"].to_pylist(), size or 0, cos, deviations, longest or 1, largest or 0)
    shared = spark.sparkContext.broadcast(index)  # at most MAX_LISTS + CODEWORDS vectors

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), CODE_BLOCK):
                yield from _coded(batch.slice(s, CODE_BLOCK), shared.value, kind)

    coded = entries.mapInArrow(code, _CODED).checkpoint()
    place, tile = ["label", "size", "shelf"], tile_of(index.width)
    full = coded.groupBy(*place).agg(F.count("*").alias("m")).where(F.col("m") > tile)  # at most a row for as many entries
    role = lambda r, shelf: F.struct(F.lit(r).alias("role"), shelf.alias("shelf"))
    sent = F.concat(F.array(role(0, F.col("shelf"))), F.transform("probed", lambda s: role(1, s)))
    dealt = coded.withColumn("sent", F.explode(sent)).drop("shelf", "probed").select("*", "sent.*").drop("sent")
    dealt = dealt.join(F.broadcast(full), place, "left")
    tiles = F.coalesce(F.ceil(F.col("m") / tile), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("id"), tiles).cast("int")
    dealt = dealt.withColumn("tile", F.explode(F.when(F.col("role") == 0, F.array(mine)).otherwise(F.sequence(F.lit(0), tiles - 1))))
    dealt = dealt.withColumn("task", F.xxhash64(*place, "tile")).drop("m", "tile", "shelf")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, base = None, [], None
        for batch in batches:
            role, keys = batch.column("role").to_numpy(), batch.column("task").to_numpy()
            at = C.runs(keys * 2 + role)
            for a, b in zip(at[:-1], at[1:], strict=True):
                part = batch.slice(int(a), int(b - a))
                if keys[a] != now:
                    now, held, base = keys[a], [], None
                if role[a] == 0:
                    held.append(_columns(part, shared.value, kind))
                else:
                    if held:
                        base, held = _tile(held, shared.value), []
                    if base is not None:
                        yield from _search(base, _columns(part, shared.value, kind), shared.value, cos)

    found = C.deal(dealt, "task", n, "role").mapInArrow(search, "id long, links long, root long").checkpoint()
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected(found, "id", "root").withColumnRenamed("node", "id")
    named = entries.join(links, "id", "left").join(roots, "id", "left")
    named = named.select("label", "vector", "weight", "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    whole = named.where("weight = 1").select("id", "n_links", "component_id")
    if copies and copies > 1:
        whole = whole.unionByName(rows.where(usable).join(named.where("weight > 1").drop("id"), ["label", "vector"]).select("id", "n_links", "component_id"))
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = whole.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
