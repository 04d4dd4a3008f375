"""Per-event feature contributions (tree Shapley values) for every scored row.

The fitted trees are read once from the saved model's node table (bounded by
``trees x 2^(depth+1)`` nodes) and turned into a leaf table: for every leaf,
its weighted value and, per feature on its path, the split conditions and
the product of cover ratios (``rawCount`` child / parent).

For path-dependent tree Shapley values, one leaf with path features ``U``
contributes ``v * prod_j (o_j if j in S else z_j)`` to the coalition value
of ``S`` (``o_j``: the row satisfies all the path's conditions on ``j``;
``z_j``: product of cover ratios of those splits). That product game has the
closed-form Shapley value

    phi_i = v * (o_i - z_i) * sum_{S subset U\\{i}} |S|!(m-|S|-1)!/m! * prod_{S} o_j * prod_{U\\S\\{i}} z_k

with ``m = |U| <= depth``. Summed over leaves and trees (times the tree
weights) this equals the exact path-dependent TreeSHAP result; the values
plus the expected margin add up to the model margin.

The rows never leave the executors: ``mapInPandas`` evaluates the closed
form per Arrow batch with numpy, the leaf table travels in the closure.
"""

from __future__ import annotations

import math
import os
import sys
import uuid
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.model import RiskModel, assemble, booster, feature_names
from leakwatch.session import ensure_checkpoint_dir

MAX_NODES = 1_000_000


def tree_nodes(model: RiskModel) -> tuple[list[dict], list[float]]:
    """Node rows of every tree plus the tree weights.

    The model is written under the shared checkpoint folder, its node table
    read back with Spark (it is bounded by the tree count and depth), and the
    folder removed.
    """
    gbt = booster(model)
    spark = SparkSession.getActiveSession()
    path = os.path.join(ensure_checkpoint_dir(spark), "leakwatch-trees", uuid.uuid4().hex)
    gbt.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    if nodes.limit(MAX_NODES + 1).count() > MAX_NODES:
        raise ValueError("tree table too large to explain")
    rows = nodes.select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.rawCount").alias("rawCount"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"),
        F.col("nodeData.split.numCategories").alias("numCategories"),
    ).collect()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return [r.asDict() for r in rows], list(gbt.treeWeights)


def leaf_table(nodes: list[dict], weights: list[float]) -> tuple[list[dict], float]:
    """Leaves with (weighted value, per-feature conditions and cover product),
    and the expected margin (base value)."""
    by_tree: dict[int, dict[int, dict]] = {}
    for n in nodes:
        by_tree.setdefault(n["treeID"], {})[n["id"]] = n
    leaves = []
    base = 0.0
    for tid, tree in by_tree.items():
        w = weights[tid]
        root = next(iter(sorted(tree)))
        stack = [(root, [])]
        while stack:
            nid, path = stack.pop()
            node = tree[nid]
            if node["left"] < 0:
                feats: dict[int, dict] = {}
                cover = 1.0
                for feat, cond, ratio in path:
                    f = feats.setdefault(feat, {"conds": [], "z": 1.0})
                    f["conds"].append(cond)
                    f["z"] *= ratio
                    cover *= ratio
                value = w * float(node["prediction"])
                base += value * cover
                leaves.append({"tree": tid, "value": value, "features": feats})
                continue
            parent = max(float(node["rawCount"]), 1.0)
            left, right = tree[node["left"]], tree[node["right"]]
            cut = tuple(node["cut"])
            categorical = node["numCategories"] >= 0
            for child, go_left in ((left, True), (right, False)):
                cond = (categorical, cut, go_left)
                stack.append((child["id"], path + [(node["feature"], cond, float(child["rawCount"]) / parent)]))
    return leaves, base


def _satisfies(x: np.ndarray, cond) -> np.ndarray:
    categorical, cut, go_left = cond
    went_left = np.isin(x, np.asarray(cut, dtype=float)) if categorical else (x <= cut[0])
    return went_left if go_left else ~went_left


def _weights(m: int) -> list[float]:
    # Shapley weight of a coalition of size s out of m players (excluding i).
    return [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]


def _subset_sum(o: dict, z: dict, others: list[int], n: int) -> np.ndarray | float:
    """sum over S of others: |S|!(m-|S|-1)!/m! * prod_S o * prod_rest z."""
    m = len(others) + 1
    if m == 1:
        return 1.0
    if m == 2:
        (j,) = others
        return 0.5 * (z[j] + o[j])
    if m == 3:
        j, k = others
        return (z[j] * z[k] + o[j] * o[k]) / 3.0 + (o[j] * z[k] + o[k] * z[j]) / 6.0
    wts = _weights(m)
    total = np.zeros(n)
    for s in range(m):
        for subset in combinations(others, s):
            term = np.full(n, wts[s])
            for j in subset:
                term = term * o[j]
            for k in others:
                if k not in subset:
                    term = term * z[k]
            total += term
    return total


def shap_matrix(x: np.ndarray, leaves: list[dict], closed_form: bool = True) -> np.ndarray:
    """Contributions (rows x features) for a batch of feature rows.

    ``closed_form`` uses the expanded sums for up to three path features
    (every depth-3 tree); otherwise the generic subset enumeration.
    """
    n, d = x.shape
    phi = np.zeros((n, d))
    cols = {}
    for leaf in leaves:
        feats = leaf["features"]
        if not feats:
            continue
        keys = list(feats)
        o = {}
        for j in keys:
            if j not in cols:
                cols[j] = np.ascontiguousarray(x[:, j])
            ok = None
            for cond in feats[j]["conds"]:
                hit = _satisfies(cols[j], cond)
                ok = hit if ok is None else ok & hit
            o[j] = ok.astype(float)
        z = {j: feats[j]["z"] for j in keys}
        for i in keys:
            others = [j for j in keys if j != i]
            if closed_form or len(keys) > 3:
                total = _subset_sum(o, z, others, n)
            else:
                wts = _weights(len(keys))
                total = np.zeros(n)
                for s_ in range(len(keys)):
                    for subset in combinations(others, s_):
                        term = np.full(n, wts[s_])
                        for j in subset:
                            term = term * o[j]
                        for k in others:
                            if k not in subset:
                                term = term * z[k]
                        total += term
            phi[:, i] += leaf["value"] * (o[i] - z[i]) * total
    return phi


MAX_TABLE_SPLITS = 10


def tree_tables(nodes: list[dict], weights: list[float], n_features: int) -> tuple[list[tuple], float]:
    """Per tree: its split conditions and a table of contributions per
    decision pattern.

    Every row's path through a tree is decided by the outcome of each split
    node (left or right), evaluated for all nodes whether reached or not.
    With K split nodes there are 2^K outcome patterns, and a row's Shapley
    contributions from that tree depend only on its pattern. For shallow
    trees (K <= MAX_TABLE_SPLITS; depth 3 gives K <= 7) the table
    ``patterns x features`` is computed once here; a batch then needs K
    comparisons and one table gather per tree. Deeper trees return ``None``
    tables and use the per-leaf evaluation.
    """
    by_tree: dict[int, dict[int, dict]] = {}
    for n in nodes:
        by_tree.setdefault(n["treeID"], {})[n["id"]] = n
    out, base = [], 0.0
    for tid in sorted(by_tree):
        tree, w = by_tree[tid], weights[tid]
        splits = sorted(i for i, n in tree.items() if n["left"] >= 0)
        index = {nid: k for k, nid in enumerate(splits)}
        conds = [(tree[nid]["feature"], tree[nid]["numCategories"] >= 0, tuple(tree[nid]["cut"])) for nid in splits]
        paths = []
        stack = [(min(tree), [])]
        while stack:
            nid, path = stack.pop()
            node = tree[nid]
            if node["left"] < 0:
                value = w * float(node["prediction"])
                cover = 1.0
                for _, _, _, ratio in path:
                    cover *= ratio
                base += value * cover
                paths.append((value, path))
                continue
            parent = max(float(node["rawCount"]), 1.0)
            for child, go_left in ((tree[node["left"]], True), (tree[node["right"]], False)):
                step = (index[nid], go_left, node["feature"], float(child["rawCount"]) / parent)
                stack.append((child["id"], path + [step]))
        if len(splits) > MAX_TABLE_SPLITS:
            out.append((conds, None))
            continue
        table = np.zeros((1 << len(splits), n_features))
        for code in range(1 << len(splits)):
            for value, path in paths:
                o: dict[int, float] = {}
                z: dict[int, float] = {}
                for k, go_left, feat, ratio in path:
                    went_left = bool((code >> k) & 1)
                    o[feat] = o.get(feat, 1.0) * (1.0 if went_left == go_left else 0.0)
                    z[feat] = z.get(feat, 1.0) * ratio
                keys = list(o)
                for i in keys:
                    others = [j for j in keys if j != i]
                    table[code, i] += value * (o[i] - z[i]) * float(_subset_sum(o, z, others, 1))
        out.append((conds, table))
    return out, base


def shap_by_tables(x: np.ndarray, tables: list[tuple], leaves_by_tree: dict[int, list[dict]]) -> np.ndarray:
    """Contributions (rows x features) from the per-tree pattern tables."""
    n, d = x.shape
    phi = np.zeros((n, d))
    for tid, (conds, table) in enumerate(tables):
        if table is None:
            phi += shap_matrix(x, leaves_by_tree.get(tid, []))
            continue
        code = np.zeros(n, dtype=np.int64)
        for k, (feat, categorical, cut) in enumerate(conds):
            went_left = np.isin(x[:, feat], np.asarray(cut, dtype=float)) if categorical else (x[:, feat] <= cut[0])
            code |= went_left.astype(np.int64) << k
        phi += table[code]
    return phi


def explain(model: RiskModel, df: DataFrame, id_col: str = S.ID, layout: str = "long") -> DataFrame:
    """Contributions of every model input for every event.

    ``layout="long"``: one row per (event, input) with ``feature``,
    ``feature_value``, ``shap_value``, ``base_value`` and ``margin``.
    ``layout="wide"``: one row per event with ``contributions`` (array of
    feature / feature_value / shap_value, sorted by contribution, largest
    first, as in a single-event report), ``base_value`` and ``margin``. Both
    are built inside the task, so neither needs a shuffle.
    """
    if layout not in ("long", "wide"):
        raise ValueError(f"unknown layout {layout!r}")
    nodes, weights = tree_nodes(model)
    inputs = feature_names(model)
    names = [c.removesuffix("_code") for c in inputs]
    tables, base = tree_tables(nodes, weights, len(inputs))
    leaves, _ = leaf_table(nodes, weights)
    # Only trees too deep for a pattern table keep their leaves in the closure.
    deep = {t for t, (_, table) in enumerate(tables) if table is None}
    leaves_by_tree: dict[int, list[dict]] = {}
    for leaf in leaves:
        if leaf["tree"] in deep:
            leaves_by_tree.setdefault(leaf["tree"], []).append(leaf)
    # The margin is the model's own; base and contributions add up to it.
    scored = booster(model).transform(assemble(model.encode(df), inputs))
    encoded = scored.select(
        id_col,
        *[F.col(c).cast("double").alias(c) for c in inputs],
        vector_to_array("rawPrediction").getItem(1).alias("_margin"),
    )
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[inputs].to_numpy(dtype=float)
            phi = shap_by_tables(x, tables, leaves_by_tree)
            yield pd.DataFrame(
                {id_col: pdf[id_col].to_numpy(), "feature_values": list(x), "shap_values": list(phi), "margin": pdf["_margin"].to_numpy()}
            )

    # Ship this module's helpers inside the closure: executors need no install.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    values = encoded.mapInPandas(run, f"{id_col} {id_type}, feature_values array<double>, shap_values array<double>, margin double")
    parts = F.arrays_zip(
        F.array(*[F.lit(n) for n in names]).alias("feature"),
        F.col("feature_values").alias("feature_value"),
        F.col("shap_values").alias("shap_value"),
    )
    base_value = F.lit(float(base)).alias("base_value")
    if layout == "wide":
        later = lambda a, b: F.when(a["shap_value"] > b["shap_value"], -1).when(a["shap_value"] < b["shap_value"], 1).otherwise(0)
        return values.select(id_col, F.array_sort(parts, later).alias("contributions"), base_value, "margin")
    long = values.select(id_col, F.inline(parts), "margin")
    return long.select(id_col, "feature", "feature_value", "shap_value", base_value, "margin")


def staged_margins(model: RiskModel, df: DataFrame, label: str = S.LABEL, after: int = 0) -> DataFrame:
    """(n_trees, score, pos, neg): the margins after each tree prefix of more
    than ``after`` trees, counted.

    Rows on the same side of every split of the model have the same margins:
    they are counted first, and the trees are evaluated once for each kind of
    row. A batch yields a row for each distinct margin of a prefix, and Spark
    sums those of all batches.
    """
    nodes, weights = tree_nodes(model)
    leaves, _ = leaf_table(nodes, weights)
    n_trees = len(weights)
    inputs = feature_names(model)
    cuts, listed = split_values(leaves, len(inputs))
    names = [f"x{i}" for i in range(len(inputs))]
    encoded = model.encode(df).where(F.col(label).isNotNull()).select(
        F.when(F.col(label).cast("int") == 1, 1).otherwise(0).alias("y"), *[F.col(c).cast("double").alias(n) for c, n in zip(inputs, names)]
    )

    def kinds(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            for i, n in enumerate(names):
                if i not in listed:  # The next split value stands for all up to it.
                    pdf[n] = cuts[i][np.searchsorted(cuts[i][:-1], pdf[n].to_numpy(), side="left")]
            yield pdf.groupby(names, dropna=False, sort=False)["y"].agg(pos="sum", n="size").reset_index()

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[names].to_numpy(dtype=float)
            positive, n = pdf["pos"].to_numpy(), pdf["n"].to_numpy()
            per_tree = np.zeros((len(pdf), n_trees))
            for leaf in leaves:
                hit = np.ones(len(pdf), dtype=bool)
                for j, f in leaf["features"].items():
                    for cond in f["conds"]:
                        hit &= _satisfies(x[:, j], cond)
                per_tree[:, leaf["tree"]] += np.where(hit, leaf["value"], 0.0)
            margins = np.cumsum(per_tree, axis=1)
            for k in range(after, n_trees):
                # Sums of equal trees in another order differ in the last bits.
                score, at = np.unique(np.round(margins[:, k], 12), return_inverse=True)
                # Counts below 2^53: exact as doubles.
                pos = np.bincount(at, weights=positive, minlength=len(score)).astype(np.int64)
                total = np.bincount(at, weights=n, minlength=len(score)).astype(np.int64)
                yield pd.DataFrame({"n_trees": np.int32(k + 1), "score": score, "pos": pos, "neg": total - pos})

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    columns = ", ".join(f"{n} double" for n in names)
    counted = encoded.mapInPandas(kinds, f"{columns}, pos long, n long").groupBy(*names).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    counted = counted.mapInPandas(run, "n_trees int, score double, pos long, neg long")
    return counted.groupBy("n_trees", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def split_values(leaves: list[dict], n_features: int) -> tuple[list[np.ndarray], set[int]]:
    """Per feature the values it is split at, ascending, with infinity for what
    lies above; and the features that a tree splits by a list of values."""
    found: list[set[float]] = [set() for _ in range(n_features)]
    listed = set()
    for leaf in leaves:
        for j, f in leaf["features"].items():
            for categorical, cut, _ in f["conds"]:
                if categorical:
                    listed.add(j)
                else:
                    found[j].add(cut[0])
    return [np.array([*sorted(v), np.inf]) for v in found], listed
