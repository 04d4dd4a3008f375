"""Spark ML: fit, importances, save/load round trip, Shapley additivity."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leakwatch.operators.explain import explain
from leakwatch.operators import metrics
from leakwatch.operators.model import BoostParams, booster, feature_importance, fit_encoder, load_model, predict, save_model
from leakwatch.plans import training
from leakwatch.plans.feature_table import feature_table
from leakwatch.sources.fixture import fixture_rules, upload_events


@pytest.fixture(scope="module")
def fitted(spark, fixture_dir):
    ft = feature_table(upload_events(spark, fixture_dir), fixture_rules())
    split_df = training.split_features(ft)
    model = training.train(split_df, BoostParams(max_iter=8))
    return model, split_df


def test_predictions_and_auc(spark, fitted):
    model, split_df = fitted
    pred = training.test_predictions(model, split_df)
    n_test = split_df.where("split = 'test'").count()
    assert pred.count() == n_test
    auc = training.evaluate(pred)["auc_roc"].first()[0]
    assert auc > 0.7  # the label is learnable from the rule features


def test_importances_sum_to_one(fitted):
    model, _ = fitted
    imp = feature_importance(model)
    assert len(imp) == 14
    assert sum(v for _, v in imp) == pytest.approx(1.0)


def test_save_load_same_predictions(spark, fitted, tmp_path):
    model, split_df = fitted
    path = str(tmp_path / "model")
    save_model(model, path)
    again = load_model(path)
    rows = split_df.where("split = 'test'")
    a = predict(model, rows).select("Action_ID", "predicted_prob").orderBy("Action_ID").collect()
    b = predict(again, rows).select("Action_ID", "predicted_prob").orderBy("Action_ID").collect()
    assert a == b


def test_shapley_sum_equals_margin(spark, fitted):
    model, split_df = fitted
    rows = split_df.where("split = 'test'")
    ex = explain(model, rows).groupBy("Action_ID").agg(
        F.sum("shap_value").alias("s"), F.first("base_value").alias("b"), F.first("margin").alias("m"))
    raw = model.transform(rows).select("Action_ID", vector_to_array("rawPrediction")[1].alias("raw"))
    j = ex.join(raw, "Action_ID").select((F.col("s") + F.col("b") - F.col("raw")).alias("d")).collect()
    assert j and np.max(np.abs([r.d for r in j])) < 1e-9


def test_unseen_category_scores(spark, fitted):
    model, split_df = fitted
    one = split_df.limit(1).withColumn("file_extension", F.lit("never-seen"))
    assert predict(model, one).count() == 1


def test_early_stop_is_a_prefix_of_one_fit(spark, fixture_dir):
    ft = feature_table(upload_events(spark, fixture_dir), fixture_rules())
    split_df = training.split_features(ft, validation_fraction=0.2)
    model, best_k, per_prefix = training.train_early_stop(split_df, BoostParams(max_iter=12), patience=3, first_round=6)
    assert booster(model).getNumTrees == best_k
    aucs = sorted((r["n_trees"], r["auc_roc"]) for r in per_prefix.collect())
    assert 6 <= len(aucs) <= 12
    # The chosen prefix has the best AUC among the prefixes scanned before stopping.
    scanned = [a for k, a in aucs if k <= best_k + 3]
    assert dict(aucs)[best_k] == max(scanned)
    # Its scores on the validation rows give that AUC, and a plain fit of as many trees the same scores.
    rows = split_df.where("split = 'validation'")
    mine = predict(model, rows).select("Action_ID", "raw_prob", F.col("Risk_Label").alias("label"))
    assert metrics.auc_roc(mine, score="raw_prob").first()[0] == pytest.approx(dict(aucs)[best_k], abs=1e-9)
    plain = training.train(split_df, BoostParams(max_iter=best_k))
    again = predict(plain, rows).select("Action_ID", F.col("raw_prob").alias("again"))
    assert mine.join(again, "Action_ID").where("abs(raw_prob - again) > 1e-9").count() == 0


def test_patience_survives_a_dip():
    dip = [(k, 0.5 + 0.001 * k if k <= 10 else 0.4 if k < 40 else 0.9 - 0.001 * k) for k in range(1, 120)]
    assert training.best_prefix(dip, patience=50) == (40, True)
    assert training.best_prefix(dip, patience=20) == (10, True)
    assert training.best_prefix(dip[:60], patience=50) == (40, False)
    assert training.best_prefix([(1, None), (2, 0.5), (3, 0.5)], patience=50) == (2, False)


def test_training_uses_every_core(spark, fitted):
    _, split_df = fitted
    assert split_df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_codes_of_many_values_unseen_and_null(spark):
    rows = spark.range(0, 100_000).selectExpr("concat('e', id) AS file_extension", "CASE WHEN id % 2 = 0 THEN 'a' END AS Position")
    encoder = fit_encoder(rows, ["file_extension", "Position"])
    assert encoder.table.count() == 100_002 and not encoder.small
    probe = spark.createDataFrame([("e0", "a"), ("e99999", None), ("new", "b"), (None, "a")], "file_extension string, Position string")
    got = [(r.file_extension, r.file_extension_code, r.Position_code) for r in encoder.encode(probe).collect()]
    assert sorted(got, key=str) == [("e0", 0, 0), ("e99999", 99_999, 1), ("new", -1, -1), (None, -1, 0)]


def test_staged_margins_count_every_row_and_end_at_the_model(spark, fitted):
    from leakwatch.operators.explain import staged_margins

    model, split_df = fitted
    rows = split_df.where("split = 'test'")
    staged = staged_margins(model, rows)
    n = rows.count()
    assert {r.n: r.c for r in staged.groupBy(F.col("n_trees").alias("n")).agg((F.sum("pos") + F.sum("neg")).alias("c")).collect()} == {k: n for k in range(1, 9)}
    raw = model.transform(rows).select(F.round(vector_to_array("rawPrediction")[1], 9).alias("m")).distinct()
    last = staged.where("n_trees = 8").select(F.round("score", 9).alias("m")).distinct()
    assert sorted(r[0] for r in raw.collect()) == sorted(r[0] for r in last.collect())


def test_closed_form_equals_enumeration(fitted):
    from leakwatch.operators.explain import leaf_table, shap_matrix, tree_nodes

    model, _ = fitted
    leaves, _ = leaf_table(*tree_nodes(model))
    x = np.random.RandomState(1).randint(0, 8, size=(500, 14)).astype(float)
    assert np.allclose(shap_matrix(x, leaves, closed_form=True), shap_matrix(x, leaves, closed_form=False),
                       atol=1e-12)


def test_pattern_tables_equal_leaf_sums(fitted):
    from leakwatch.operators import explain as X

    model, _ = fitted
    nodes, weights = X.tree_nodes(model)
    leaves, base = X.leaf_table(nodes, weights)
    tables, base2 = X.tree_tables(nodes, weights, 14)
    x = np.random.RandomState(2).randint(0, 8, size=(400, 14)).astype(float)
    assert base == pytest.approx(base2)
    assert np.allclose(X.shap_by_tables(x, tables, {}), X.shap_matrix(x, leaves), atol=1e-12)
    # A deep tree falls back to the leaf loop and gives the same values.
    by_tree = {}
    for leaf in leaves:
        by_tree.setdefault(leaf["tree"], []).append(leaf)
    mixed = [(c, None) if i == 0 else (c, t) for i, (c, t) in enumerate(tables)]
    assert np.allclose(X.shap_by_tables(x, mixed, by_tree), X.shap_matrix(x, leaves), atol=1e-12)


def test_tuned_threshold_on_validation(spark, fixture_dir):
    ft = feature_table(upload_events(spark, fixture_dir), fixture_rules())
    split_df = training.split_features(ft, validation_fraction=0.2)
    model = training.train(split_df, BoostParams(max_iter=5))
    row = training.tuned_threshold(model, split_df).first()
    n_test = split_df.where("split = 'test'").count()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == n_test
    assert 0.0 <= row["threshold"] <= 1.0


def test_wide_layout_sorted_and_consistent(spark, fitted):
    model, split_df = fitted
    rows = split_df.where("split = 'test'").limit(50)
    wide = explain(model, rows, layout="wide").collect()
    assert len(wide) == 50
    for r in wide:
        vals = [c["shap_value"] for c in r["contributions"]]
        assert vals == sorted(vals, reverse=True) and len(vals) == 14
        assert abs(sum(vals) + r["base_value"] - r["margin"]) < 1e-9
