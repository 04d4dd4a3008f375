import math
import random
import re

import pytest
from pyspark.sql import functions as F

from leakwatch.operators import boosting, metrics
from leakwatch.operators.boosting import Boosting
from leakwatch.operators.model import BoostParams, assemble, booster, fit_classifier, load_model, predict, save_model, start_fit
from leakwatch.plans import training

BOUNDS = [[1.0, 2.0, 3.0], [0.25, 0.5, 0.75], [0.0]]


def rows_of(n=300, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.choice([0.0, 1.0, 2.0, 3.0, 4.0, None]), r.choice([r.random(), float("nan")]) if r.random() < 0.2 else r.random(), r.choice([0.0, 1.0])
        y = int(r.random() < (0.8 if (a or 0) > 2 and b > 0.5 else 0.2 + 0.3 * c))
        out.append((a, b, c, y, i % 4 != 0))
    return out + [(1.0, 0.5, 0.0, None, True)] + [(2.0, 0.3, 1.0, 1, True)] * 5


def plain_boosting(rows, n_trees, depth=3, step=0.1):
    """Every split of every bound by sums over lists of rows."""
    def goes_left(row, f, t):
        v = row[f]
        return v is not None and not math.isnan(v) and v <= t

    def variance(t):
        return sum(v * v for v in t) / len(t) - (sum(t) / len(t)) ** 2

    def grow(at, target, level):
        own = [target[i] for i in at]
        value = sum(own) / len(own)
        best = (0.0, None)
        if level < depth:
            for f, bounds in enumerate(BOUNDS):
                for t in bounds:
                    left = [i for i in at if goes_left(rows[i], f, t)]
                    right = [i for i in at if not goes_left(rows[i], f, t)]
                    if left and right:
                        parts = sum(len(p) / len(at) * variance([target[i] for i in p]) for p in (left, right))
                        gain = round(variance(own) - parts, 10)
                        if gain > best[0]:
                            best = (gain, (f, t, left, right))
        if best[1] is None:
            return {"value": value}
        f, t, left, right = best[1]
        return {"value": value, "feature": f, "bound": t, "left": grow(left, target, level + 1), "right": grow(right, target, level + 1)}

    def walk(tree, row):
        while "feature" in tree:
            tree = tree["left"] if goes_left(row, tree["feature"], tree["bound"]) else tree["right"]
        return tree["value"]

    y = [None if r[3] is None else 2 * r[3] - 1 for r in rows]
    margin, trees = [0.0] * len(rows), []
    fits = [i for i, r in enumerate(rows) if r[4] and r[3] is not None]
    for k in range(n_trees):
        target = {i: y[i] if k == 0 else 4 * y[i] / (1 + math.exp(2 * y[i] * margin[i])) for i in fits}
        tree = grow(fits, target, 0)
        trees.append(tree)
        margin = [m + (1.0 if k == 0 else step) * walk(tree, r) for m, r in zip(margin, rows)]
    return trees, margin


def as_plain(tree, bounds, i=0):
    if i not in tree.feature:
        return {"value": pytest.approx(tree.value(i), abs=1e-9)}
    f = tree.feature[i]
    return {"value": pytest.approx(tree.value(i), abs=1e-9), "feature": f, "bound": bounds[f][tree.bin[i]],
            "left": as_plain(tree, bounds, 2 * i + 1), "right": as_plain(tree, bounds, 2 * i + 2)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, label int, fits boolean")


@pytest.mark.parametrize("max_partial", [1_000_000, 0])
def test_every_split_equals_brute_force_and_growing_on_changes_nothing(spark, monkeypatch, max_partial):
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    monkeypatch.setattr(boosting, "MAX_PARTIAL_CELLS", max_partial)
    rows = rows_of()
    plain, _ = plain_boosting(rows, 5)
    df = frame(spark, rows).repartition(3)
    fit = Boosting(df, ["a", "b", "c"], "label", BoostParams(), BOUNDS)
    fit.grow(2)
    fit.grow(3)
    assert plain == [as_plain(t, BOUNDS) for t in fit.trees]
    assert sum(len(t.feature) for t in fit.trees) > 10


def test_counted_margins_are_those_of_the_spark_model(spark):
    rows = rows_of()
    df = frame(spark, rows)
    fit = Boosting(df, ["a", "b", "c"], "label", BoostParams(), BOUNDS)
    fit.grow(2)
    parts = [fit.staged().collect()]
    fit.grow(2)
    parts.append(fit.staged().collect())
    _, margin = plain_boosting(rows, 4)
    wanted = {}
    for m, r in zip(margin, rows):
        if not r[4] and r[3] is not None:
            wanted.setdefault(round(m, 8), [0, 0])[1 - r[3]] += 1
    got = {round(r.score, 8): [r.pos, r.neg] for r in parts[1] if r.n_trees == 4}
    assert got == wanted
    assert {r.n_trees for r in parts[0]} == {1, 2} and {r.n_trees for r in parts[1]} == {3, 4}
    model = fit.booster()
    assert model.getNumTrees == 4 and list(model.treeWeights) == [1.0, 0.1, 0.1, 0.1]
    nan = [F.coalesce(c, F.lit(float("nan"))).alias(c) for c in "abc"]
    from pyspark.ml.feature import VectorAssembler

    x = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(df.select(*nan))
    raw = [r.rawPrediction[1] for r in model.transform(x).select("rawPrediction").collect()]
    assert sorted(raw) == pytest.approx(sorted(margin), abs=1e-9)


def test_empty_training_and_bounds(spark):
    df = frame(spark, [(1.0, 2.0, 3.0, 1, False)])
    fit = Boosting(df, ["a", "b", "c"], "label")
    fit.grow(2)
    assert [r.score for r in fit.staged().collect()] == [0.0, 0.0] and fit.booster().getNumTrees == 2
    values = spark.range(1000).selectExpr("double(id) AS a", "CASE WHEN id = 7 THEN 1D ELSE 0D END AS b", "double(null) AS c")
    a, b, c = boosting.quantile_bounds(values, ["a", "b", "c"], 4)
    assert a == pytest.approx([250, 500, 750], abs=2) and b == [0.0] and c == []
    with pytest.raises(ValueError):
        boosting.quantile_bounds(values, ["a"], 257)


def test_early_stop_grows_on_from_kept_margins(spark, tmp_path):
    r = random.Random(9)
    rows = []
    for i in range(3000):
        x, z = r.random(), r.randint(0, 20)
        rows.append((i, r.choice("pqrs"), int(r.random() < (0.75 if x * z > 6 else 0.2)), x, float(z), ("train", "train", "validation", "test")[i % 4]))
    df = spark.createDataFrame(rows, "Action_ID long, kind string, Risk_Label int, x double, z double, split string").repartition(4).checkpoint()
    model, best, per_prefix = training.train_continued(df, BoostParams(max_iter=60), 5, 4, categorical=["kind"], numeric=["x", "z"])
    aucs = {r.n_trees: r.auc_roc for r in per_prefix.collect()}
    assert sorted(aucs) == list(range(1, len(aucs) + 1)) and len(aucs) <= min(60, best + 5 + 4)
    pred = predict(model, df.where("split = 'validation'")).select(F.col("Risk_Label").alias("label"), F.col("raw_prob").alias("score"))
    assert metrics.auc_roc(pred).first()[0] == pytest.approx(aucs[best], abs=1e-9) and aucs[best] > 0.7
    save_model(model, str(tmp_path / "m"))
    a, b = (predict(m, df).agg(F.sum("raw_prob")).first()[0] for m in (model, load_model(str(tmp_path / "m"))))
    assert a == pytest.approx(b)


def small_table(spark, n=2000, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x, z, k = r.random(), r.randint(-3, 40), r.choice("pqrs")
        rows.append((i, k, int(r.random() < (0.8 if x * z > 6 or k == "q" else 0.2)), x, float(z), float(r.random() < 0.1), ("train", "train", "validation", "test")[i % 4]))
    return spark.createDataFrame(rows, "Action_ID long, kind string, Risk_Label int, x double, z double, f double, split string").repartition(4).checkpoint()


def test_fit_equals_spark_ml(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    df = small_table(spark)
    model = fit_classifier(df, BoostParams(max_iter=6), ["kind"], ["x", "z", "f"])
    coded = assemble(model.encode(df), model.inputs)
    ml = GBTClassifier(labelCol="Risk_Label", maxIter=6, maxDepth=3, stepSize=0.1, seed=42, maxBins=32).fit(coded)
    # The splits are the same; sums in another order differ in the last bits.
    plain = [re.sub(r"Predict: .*", lambda m: f"{float(m[0][9:]):.9f}", t.toDebugString).split("\n")[1:] for t in (booster(model), ml)]
    assert plain[0] == plain[1] and len(plain[0]) > 60
    a, b = (m.transform(coded).agg(F.sum(F.abs(vector_to_array("rawPrediction")[1]))).first()[0] for m in (model.booster, ml))
    assert a == pytest.approx(b, abs=1e-6)


def test_bounds_of_many_values_come_from_all_rows(spark, monkeypatch):
    # 40,000 rows, more than Spark ML looks at; value 5 stands in one row alone.
    df = spark.range(40_000).selectExpr("CASE WHEN id = 77 THEN 5D ELSE -0D END AS a", "double(id % 100) AS b", "CASE WHEN id % 2 = 0 THEN double('NaN') END AS c")
    assert boosting.split_bounds(df, ["a", "b", "c"], 4) == [[2.5], [24.5, 49.5, 74.5], []]
    monkeypatch.setattr(boosting, "MAX_COUNTED_VALUES", 50)
    a, b, _ = boosting.split_bounds(df, ["a", "b", "c"], 4)
    assert a == [2.5] and b == pytest.approx([25, 50, 75], abs=2)


def test_rows_alike_are_kept_once_in_few_tasks(spark):
    rows = rows_of()
    once, often = frame(spark, rows), frame(spark, rows).crossJoin(spark.range(40)).drop("id").repartition(60)
    fits = [Boosting(df, ["a", "b", "c"], "label", BoostParams(), BOUNDS) for df in (once, often)]
    for fit in fits:
        fit.grow(3)
    assert len({fit.blocks.agg(F.sum("n")).first()[0] for fit in fits}) == 1
    assert fits[1].blocks.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert [as_plain(t, BOUNDS) for t in fits[0].trees] == [as_plain(t, BOUNDS) for t in fits[1].trees]
    assert [r[:2] + (r[2] * 40, r[3] * 40) for r in sorted(fits[0].staged().collect())] == [tuple(r) for r in sorted(fits[1].staged().collect())]


def test_deep_trees_end_in_the_same_nodes(spark):
    rows = [r for r in rows_of(800) if r[3] is not None]
    fit = Boosting(frame(spark, rows), ["a", "b", "c"], "label", BoostParams(max_depth=5), BOUNDS)
    fit.grow(2)
    assert max(len(t.feature) for t in fit.trees) > boosting.MAX_PATTERN_SPLITS
    plain, _ = plain_boosting(rows, 2, depth=5)
    assert plain == [as_plain(t, BOUNDS) for t in fit.trees]


def test_early_stop_grows_no_tree_twice(spark, monkeypatch):
    grown = []
    one = Boosting._next_tree
    monkeypatch.setattr(Boosting, "_next_tree", lambda fit: grown.append(len(fit.trees)) or one(fit))
    df = small_table(spark)
    _, best, per_prefix = training.train_early_stop(df, BoostParams(max_iter=10), patience=50, first_round=3, categorical=["kind"], numeric=["x", "z"])
    assert grown == list(range(10))
    assert sorted(r.n_trees for r in per_prefix.collect()) == list(range(1, 11)) and 1 <= best <= 10


def test_labels_of_a_fit_are_checked(spark):
    df = small_table(spark).withColumn("kind_code", F.lit(0))
    with pytest.raises(ValueError, match="labels"):
        start_fit(df.withColumn("Risk_Label", F.when(F.col("Action_ID") > 0, F.col("Risk_Label"))), ["x"])
    with pytest.raises(ValueError, match="labels"):
        start_fit(df.where("false"), ["x"])
