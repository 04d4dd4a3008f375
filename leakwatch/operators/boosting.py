"""Boosted trees grown from histograms, continued from kept margins.

Spark ML's own fit starts over whenever more trees are wanted, and keeps every
row as an object of its own. Here the rows are binned once; rows with the same
bins and label, which no tree can tell apart, are counted and kept once (in the
worst case that is every row). They are packed: a block holds the bins of up to
``BLOCK_ROWS`` of them as bytes, their labels, their counts and their margins so
far, in at most as many partitions as there are cores, whatever the size. A level of a
tree is one aggregate for all nodes and features: each task
adds up its blocks into (node, feature, bin) cells, Spark sums the cells of all
tasks, and the driver, which sees at most nodes x features x bins rows, picks the
splits. While tasks x cells is at most ``MAX_PARTIAL_CELLS``, the driver sums them
itself: the same sums with one shuffle less a level.
Margins are written to a checkpoint every ``KEEP_EVERY`` trees, so growing on
costs only the new trees and a lost executor repeats few.

Loss, first tree, leaf values and margins are those of Spark ML's boosting
(labels -1 and 1, first tree of weight 1, later ones of the step size on the
residuals ``4y / (1 + exp(2y * margin))``), so the trees become a Spark ML
model that is scored, explained and saved like any other. The bounds of the bins
are Spark ML's (``split_bounds``) or approximate quantiles (``quantile_bounds``),
both of all training rows.

Defined results: rows without a label are left out; a null or NaN input goes to
the right of every split; equal gains take the first input, then the lowest
bound; no training rows give trees of a single leaf 0.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch.operators.model import BoostParams

BLOCK_ROWS = 65_536
MIN_TASK_ROWS = 16_384
KEEP_EVERY = 10
MAX_PARTIAL_CELLS = 1_000_000
MAX_BINS = 256  # a bin is one byte
MAX_COUNTED_VALUES = 20_000  # inputs with more distinct values (by estimate) are bounded by quantiles
MAX_PATTERN_SPLITS = 8  # splits of a tree whose outcomes fit one byte
BLOCK_SCHEMA = "fits boolean, n int, bins binary, y binary, weight binary, margin binary"
_ARROW = pa.schema([("fits", pa.bool_()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("bins", "y", "weight", "margin")]])


@dataclass
class Tree:
    """Nodes by place: the children of ``i`` are ``2i + 1`` and ``2i + 2``.
    ``stats`` holds (rows, sum, sum of squares) of a node's targets."""

    weight: float
    feature: dict[int, int] = field(default_factory=dict)
    bin: dict[int, int] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    stats: dict[int, tuple[float, float, float]] = field(default_factory=dict)

    def value(self, i: int) -> float:
        n, s, _ = self.stats[i]
        return s / n if n else 0.0

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row (column of ``bins``) ends in."""
        code, ends = self._patterns(bins)
        return ends[code]

    def margins(self, bins: np.ndarray) -> np.ndarray:
        values = np.zeros(max(self.stats) + 1)
        for i in self.stats:
            values[i] = self.value(i)
        code, ends = self._patterns(bins)
        return (self.weight * values[ends])[code]

    def _patterns(self, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of each row, node of each code): a code holds the outcomes of
        all splits as bits, or with more splits than bits is the node itself."""
        splits = sorted(self.feature)
        if len(splits) > MAX_PATTERN_SPLITS:
            at = np.zeros(bins.shape[1], dtype=np.int64)
            for i in splits:
                here = at == i
                at[here] = 2 * i + 1 + (bins[self.feature[i], here] > self.bin[i])
            return at, np.arange(2 * splits[-1] + 3)
        code = np.zeros(bins.shape[1], dtype=np.uint8)
        for k, i in enumerate(splits):
            code |= (bins[self.feature[i]] > self.bin[i]).view(np.uint8) << np.uint8(k)
        ends = np.zeros(1 << len(splits), dtype=np.int64)
        codes = np.arange(len(ends))
        for k, i in enumerate(splits):
            here = ends == i
            ends[here] = 2 * i + 1 + ((codes[here] >> k) & 1)
        return code, ends


def _number(name: str):
    """The column as a double, null for NaN, zero without a sign."""
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))


def quantile_bounds(train: DataFrame, inputs: list[str], max_bins: int) -> list[list[float]]:
    """Bounds between the bins of each input: at most ``max_bins - 1``."""
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be 2 to {MAX_BINS}")
    shares = [k / max_bins for k in range(1, max_bins)]
    row = train.agg(*[F.percentile_approx(_number(c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(inputs)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(len(inputs))]


def split_bounds(train: DataFrame, inputs: list[str], max_bins: int) -> list[list[float]]:
    """Bounds where Spark ML's trees may split: midpoints of neighbouring values,
    all of them or, with too many values, those that come nearest to bins of
    equally many rows. Spark ML counts the values of about 10,000 rows; here
    they are counted over all rows, and an input of more than
    ``MAX_COUNTED_VALUES`` values gets the quantiles of all its rows.
    """
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"max_bins must be 2 to {MAX_BINS}")
    row = train.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(_number(c)).alias(f"d{i}") for i, c in enumerate(inputs)]).first()
    wide = [i for i in range(len(inputs)) if row[f"d{i}"] > MAX_COUNTED_VALUES]
    bounds: list[list[float]] = [[] for _ in inputs]
    if wide:
        for i, own in zip(wide, quantile_bounds(train, [inputs[i] for i in wide], max_bins)):
            bounds[i] = own
    counted = [F.struct(F.lit(i).alias("i"), _number(c).alias("v")) for i, c in enumerate(inputs) if i not in wide]
    if not counted:
        return bounds
    # At most MAX_COUNTED_VALUES (within the estimate's error) rows an input.
    values = train.select(F.inline(F.array(*counted))).where("v IS NOT NULL").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).toArrow()
    place, value, n = (values.column(c).to_numpy() for c in "ivn")
    for i in range(len(inputs)):
        if i not in wide:
            own = np.flatnonzero(place == i)
            own = own[np.argsort(value[own])]
            bounds[i] = midpoints(value[own], n[own], min(max_bins, row["n"]) - 1, row["n"])
    return bounds


def midpoints(values: np.ndarray, counts: np.ndarray, n_splits: int, n_rows: int) -> list[float]:
    """At most ``n_splits`` of the midpoints of ``values`` (ascending), chosen as Spark ML does."""
    between = [float(m) for m in (values[:-1] + values[1:]) / 2]
    if len(between) <= n_splits:
        return between
    stride = n_rows / (n_splits + 1)
    taken, target = [], stride
    upto = np.cumsum(counts)
    for k, middle in enumerate(between):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            taken.append(middle)
            target += stride
    return taken


def pack(rows: DataFrame, inputs: list[str], label: str, bounds: list[list[float]]) -> DataFrame:
    """Blocks of binned rows, each with the number of rows like it; ``rows``
    have ``fits`` (true: the trees learn from them)."""
    width = len(bounds) + 2

    def binned(held):
        table = pa.Table.from_batches(held)
        cells = np.empty((table.num_rows, width), dtype=np.uint8)
        for i, b in enumerate(bounds):
            cells[:, i] = np.searchsorted(np.array(b, dtype=float), table.column(f"x{i}").to_numpy(), side="left")
        cells[:, -2] = table.column("fits").to_numpy()
        cells[:, -1] = table.column("y").to_numpy()
        like, n = np.unique(cells.view(f"V{width}").ravel(), return_counts=True)
        like = pa.Array.from_buffers(pa.binary(width), len(like), [None, pa.py_buffer(like.tobytes())])
        return pa.RecordBatch.from_arrays([like.cast(pa.binary()), pa.array(n.astype(np.int64))], names=["like", "n"])

    def blocks(held):
        table = pa.Table.from_batches(held)
        cells = np.frombuffer(b"".join(table.column("like").to_pylist()), dtype=np.uint8).reshape(-1, width)
        weight = table.column("n").to_numpy()
        for part in (True, False):
            take = cells[:, -2] == part
            n = int(take.sum())
            if n:
                bins = np.ascontiguousarray(cells[take, :-2].T)
                y = 2 * cells[take, -1].astype(np.int8) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], t.type) for c, t in zip([part, n, bins.tobytes(), y.astype(np.int8).tobytes(), weight[take].tobytes(), np.zeros(n).tobytes()], _ARROW)],
                    schema=_ARROW,
                )

    def count(batches):
        for held in _held(batches):
            yield binned(held)

    def run(batches):
        for held in _held(batches):
            yield from blocks(held)

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    y = F.when(F.col(label) == 1, 1).otherwise(0).alias("y")
    x = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(inputs)]
    counted = rows.where(F.col(label).isNotNull()).select("fits", y, *x).mapInArrow(count, "like binary, n long")
    # Each task sends a kind of row once for each BLOCK_ROWS rows: none is hot.
    counted = counted.repartition(rows.sparkSession.sparkContext.defaultParallelism, "like").groupBy("like").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(run, BLOCK_SCHEMA)


def _held(batches):
    """Lists of batches with ``BLOCK_ROWS`` rows or a few more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield held
            held, n = [], 0
    if n:
        yield held


def _read(batches, n_inputs: int):
    for batch in batches:
        for r in batch.to_pylist():
            bins = np.frombuffer(r["bins"], dtype=np.uint8).reshape(n_inputs, r["n"])
            yield r, bins, np.frombuffer(r["y"], dtype=np.int8).astype(float), np.frombuffer(r["weight"], dtype=np.int64), np.frombuffer(r["margin"])


def level_cells(blocks: DataFrame, grown: list[Tree], tree: Tree, open_nodes: list[int], n_inputs: int, max_bins: int, first: bool, n_tasks: int) -> np.ndarray:
    """(open node, input, bin, [rows, sum, sum of squares]) of the targets over all training rows."""
    place = {node: k for k, node in enumerate(open_nodes)}
    size = len(open_nodes) * n_inputs * max_bins

    def run(batches):
        total = np.zeros((3, size))
        for _, bins, y, weight, margin in _read(batches, n_inputs):
            for t in grown:
                margin = margin + t.margins(bins)
            target = y if first else 4 * y / (1 + np.exp(2 * y * margin))
            at = tree.nodes_of(bins)
            slot = np.full(at.max() + 1, -1)
            for node, k in place.items():
                if node < len(slot):
                    slot[node] = k
            slot = slot[at]
            here = slot >= 0
            target, n, first_cell = target[here], weight[here].astype(float), slot[here] * (n_inputs * max_bins)
            sums = (n, n * target, n * target * target)
            for f in range(n_inputs):
                cell = first_cell + (f * max_bins + bins[f, here].astype(np.int64))
                for row, w in zip(total, sums):
                    row += np.bincount(cell, weights=w, minlength=size)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(row[used]) for row in total]], names=["cell", "n", "s", "q"])

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    parts = blocks.where("fits").mapInArrow(run, "cell int, n double, s double, q double")
    if n_tasks * size > MAX_PARTIAL_CELLS:
        parts = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    sums = parts.toArrow()
    out = np.zeros((size, 3))
    for k, name in enumerate("nsq"):
        np.add.at(out[:, k], sums.column("cell").to_numpy(), sums.column(name).to_numpy())
    return out.reshape(len(open_nodes), n_inputs, max_bins, 3)


def _impurity(stats: np.ndarray) -> np.ndarray:
    n = np.maximum(stats[..., 0], 1)
    return np.maximum(stats[..., 2] / n - (stats[..., 1] / n) ** 2, 0.0)


def split_gains(cells: np.ndarray) -> np.ndarray:
    """(input, bin): drop in variance when the bins up to this one go left;
    -1 where a side would be empty. Rounded, as sums of the same rows in
    another order differ in the last bits."""
    left = np.cumsum(cells, axis=1)
    total = left[:, -1:, :]
    right = total - left
    n = np.maximum(total[..., 0], 1)
    gain = _impurity(total) - left[..., 0] / n * _impurity(left) - right[..., 0] / n * _impurity(right)
    return np.where((left[..., 0] > 0) & (right[..., 0] > 0), np.round(gain, 10), -1.0)


class Boosting:
    """A fit that can be grown on. ``rows``: the inputs, the label and ``fits``."""

    def __init__(self, rows: DataFrame, inputs: list[str], label: str, params: BoostParams = BoostParams(), bounds: list[list[float]] | None = None):
        self.inputs, self.params = list(inputs), params
        self.bounds = quantile_bounds(rows.where("fits"), inputs, params.max_bins) if bounds is None else bounds
        self.n_bins = max([len(b) for b in self.bounds], default=0) + 1
        if self.n_bins > MAX_BINS:
            raise ValueError(f"an input has {self.n_bins} bins, more than {MAX_BINS}")
        self.blocks = pack(rows, inputs, label, self.bounds).checkpoint(eager=True)
        kinds = self.blocks.agg(F.sum("n")).first()[0] or 0
        self.n_tasks = min(self.blocks.rdd.getNumPartitions(), max(1, math.ceil(kinds / MIN_TASK_ROWS)))
        self.blocks = self.blocks.coalesce(self.n_tasks)
        self.staged_blocks, self.n_staged = self.blocks, 0
        self.trees: list[Tree] = []
        self.n_kept = 0

    def grow(self, n_trees: int) -> None:
        for _ in range(n_trees):
            self.trees.append(self._next_tree())
            if len(self.trees) - self.n_kept >= KEEP_EVERY:
                self._keep_margins()

    def _next_tree(self) -> Tree:
        first = not self.trees
        tree = Tree(1.0 if first else self.params.step_size)
        open_nodes = [0]
        for _ in range(self.params.max_depth):
            cells = level_cells(self.blocks, self.trees[self.n_kept:], tree, open_nodes, len(self.inputs), self.n_bins, first, self.n_tasks)
            below = []
            for node, own in zip(open_nodes, cells):
                tree.stats.setdefault(node, tuple(own[0].sum(axis=0)))
                gains = split_gains(own)
                f, b = divmod(int(np.argmax(gains)), self.n_bins)
                if gains[f, b] <= 0:
                    continue
                tree.feature[node], tree.bin[node], tree.gain[node] = f, b, float(gains[f, b])
                tree.stats[2 * node + 1] = tuple(own[f, : b + 1].sum(axis=0))
                tree.stats[2 * node + 2] = tuple(own[f, b + 1 :].sum(axis=0))
                below += [2 * node + 1, 2 * node + 2]
            open_nodes = below
            if not open_nodes:
                break
        return tree if tree.stats else Tree(tree.weight, stats={0: (0.0, 0.0, 0.0)})

    def root_gains(self) -> list[tuple[str, float, int, int, float | None]]:
        """(input, bound, rows left, label-1 rows left, gain) of every possible
        first split; no gain where a side is empty. One row per bound."""
        cells = level_cells(self.blocks, [], Tree(1.0), [0], len(self.inputs), self.n_bins, True, self.n_tasks)[0]
        gains, left = split_gains(cells), np.cumsum(cells, axis=1)
        return [
            (name, float(bound), int(left[f, b, 0]), int((left[f, b, 0] + left[f, b, 1]) / 2), None if gains[f, b] == -1 else float(gains[f, b]))
            for f, name in enumerate(self.inputs) for b, bound in enumerate(self.bounds[f])
        ]

    def _keep_margins(self) -> None:
        n_inputs, new = len(self.inputs), self.trees[self.n_kept:]

        def run(batches):
            for r, bins, _, _, margin in _read(batches, n_inputs):
                for t in new:
                    margin = margin + t.margins(bins)
                yield pa.RecordBatch.from_pylist([{**r, "margin": margin.tobytes()}], schema=_ARROW)

        self.blocks = self.blocks.mapInArrow(run, BLOCK_SCHEMA).checkpoint(eager=True)
        self.n_kept = len(self.trees)

    def staged(self) -> DataFrame:
        """(n_trees, score, pos, neg): margins of the rows that do not fit, counted,
        after each tree grown since the last call."""
        n_inputs, start, new = len(self.inputs), self.n_staged, self.trees[self.n_staged:]

        def run(batches):
            for _, bins, y, weight, margin in _read(batches, n_inputs):
                for k, t in enumerate(new, start + 1):
                    margin = margin + t.margins(bins)
                    score, at = np.unique(np.round(margin, 12), return_inverse=True)
                    # Counts below 2^53: exact as doubles.
                    pos = np.bincount(at, weights=weight * (y == 1), minlength=len(score)).astype(np.int64)
                    all_ = np.bincount(at, weights=weight, minlength=len(score)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), k, np.int32)), pa.array(score), pa.array(pos), pa.array(all_ - pos)], names=["n_trees", "score", "pos", "neg"])

        counted = self.staged_blocks.where("NOT fits").mapInArrow(run, "n_trees int, score double, pos long, neg long")
        if self.n_kept < len(self.trees):
            self._keep_margins()
        self.staged_blocks, self.n_staged = self.blocks, len(self.trees)
        return counted.groupBy("n_trees", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def booster(self, n_trees: int | None = None) -> GBTClassificationModel:
        """The first ``n_trees`` trees (default: all) as a Spark ML model."""
        sc = SparkContext._active_spark_context
        gateway, jvm = sc._gateway, sc._jvm
        ml = jvm.org.apache.spark.ml

        def node(tree: Tree, i: int):
            stats = gateway.new_array(jvm.double, 3)
            stats[0], stats[1], stats[2] = (float(v) for v in tree.stats[i])
            calc = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(tree.stats[i][0]))
            impurity = float(_impurity(np.array(tree.stats[i])))
            if i not in tree.feature:
                return ml.tree.LeafNode(tree.value(i), impurity, calc)
            f = tree.feature[i]
            # Inputs beyond the last bound have the last bin: no split stands there.
            split = ml.tree.ContinuousSplit(f, float(self.bounds[f][tree.bin[i]]))
            return ml.tree.InternalNode(tree.value(i), impurity, tree.gain[i], node(tree, 2 * i + 1), node(tree, 2 * i + 2), split, calc)

        taken = self.trees[:n_trees]
        trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(taken))
        weights = gateway.new_array(jvm.double, len(taken))
        uid = "gbtc_histograms"
        for k, tree in enumerate(taken):
            trees[k] = ml.regression.DecisionTreeRegressionModel(f"{uid}_{k}", node(tree, 0), len(self.inputs))
            weights[k] = float(tree.weight)
        return GBTClassificationModel(ml.classification.GBTClassificationModel(uid, trees, weights, len(self.inputs), 2))
