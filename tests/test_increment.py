"""Ingest/scoring increments: anti-join semantics, ids, idempotent appends."""

import datetime as dt

from pyspark.sql import functions as F

from leakwatch.operators import increment, reports
from leakwatch.sources.catalog import table_exists


def test_anti_join_semantics(spark):
    target = spark.createDataFrame([(1,), (2,), (None,)], "Action_ID long")
    batch = spark.createDataFrame([(2, "b"), (3, "c"), (3, "c")], "Action_ID long, v string")
    out = increment.new_rows(batch, target).collect()
    assert [(r.Action_ID, r.v) for r in out] == [(3, "c")]
    assert increment.new_rows(batch, None).count() == 2


def test_null_keys_stay_and_equal_ids_keep_the_same_row(spark):
    target = spark.createDataFrame([(1,), (None,)], "Action_ID long")
    rows = [(None, "x", 1), (None, "x", 1), (1, "old", 0), (2, "b", 9), (2, "b", None), (2, "a", 5), (2, "c", 1)]
    for order in (rows, rows[::-1]):
        batch = spark.createDataFrame(order, "Action_ID long, v string, n int").repartition(3)
        for prune in (False, True):
            out = increment.new_rows(batch, target, prune_to_batch_range=prune)
            assert out.columns == batch.columns
            assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, "x", 1)] * 2 + [(2, "a", 5)], key=str)
    only_null = spark.createDataFrame([(None, "x"), (None, "y")], "Action_ID long, v string")
    assert increment.new_rows(only_null, target).count() == increment.new_rows(only_null, target, prune_to_batch_range=True).count() == 2
    assert increment.new_rows(spark.createDataFrame([(3,), (3,)], "Action_ID long"), target).count() == 1


def test_next_id_empty_and_filled(spark):
    empty = spark.createDataFrame([], "Action_ID long")
    assert reports.next_id(empty).first()[0] == 1
    filled = spark.createDataFrame([(5,), (9,)], "Action_ID long")
    assert reports.next_id(filled).first()[0] == 10


def test_assign_ids_consecutive(spark):
    existing = spark.createDataFrame([(41,)], "Action_ID long")
    batch = spark.range(0, 37).repartition(5).select(F.col("id").alias("payload"))
    ids = sorted(r.Action_ID for r in increment.assign_ids(batch, existing).collect())
    assert ids == list(range(42, 79))


def test_append_new_is_idempotent(spark):
    name = "inc_target_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "Action_ID long, v string")
    assert increment.append_new(spark, rows, name) == 2
    assert increment.append_new(spark, rows, name) == 0
    more = spark.createDataFrame([(2, "b"), (3, "c")], "Action_ID long, v string")
    assert increment.append_new(spark, more, name) == 1
    assert spark.table(name).count() == 3


def test_unscored_first_run_and_recent_filter(spark):
    assert not table_exists(spark, "no_such_predictions")
    t0 = dt.datetime(2024, 1, 10, 12, 0, 0)
    rows = [(i, t0 - dt.timedelta(hours=h)) for i, h in enumerate([0, 5, 24, 25, 48])]
    df = spark.createDataFrame(rows, "Action_ID long, Timestamp timestamp_ntz")
    recent = reports.recent(df, 24, t0)
    assert sorted(r.Action_ID for r in recent.collect()) == [0, 1, 2]  # inclusive bound
    assert increment.unscored_since(recent, spark, "no_such_predictions", t0 - dt.timedelta(hours=24)).count() == 3


def test_recent_filter_pushed_to_scan(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 10)
    path = str(tmp_path / "ev")
    spark.createDataFrame([(1, t0)], "Action_ID long, Timestamp timestamp_ntz").write.parquet(path)
    plan = reports.recent(spark.read.parquet(path), 24, t0)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Timestamp), GreaterThanOrEqual(Timestamp" in plan


def test_pruned_anti_join_matches_and_pushes(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(0, 5000).select(F.col("id").alias("Action_ID")).write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.createDataFrame([(4990,), (5001,), (5001,), (7000,)], "Action_ID long")
    a = sorted(r[0] for r in increment.new_rows(batch, target).collect())
    b = sorted(r[0] for r in increment.new_rows(batch, target, prune_to_batch_range=True).collect())
    assert a == b == [5001, 7000]
    plan = increment.new_rows(batch, target, prune_to_batch_range=True)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "GreaterThanOrEqual(Action_ID,4990)" in plan and "LessThanOrEqual(Action_ID,7000)" in plan


def test_unscored_since_reads_recent_predictions_only(spark):
    t0 = dt.datetime(2024, 1, 10)
    name = "preds_since_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([(1, t0), (2, t0 - dt.timedelta(days=3))], "Action_ID long, Timestamp timestamp_ntz") \
        .write.saveAsTable(name)
    feats = spark.createDataFrame([(1, t0), (3, t0), (2, t0 - dt.timedelta(days=3))],
                                  "Action_ID long, Timestamp timestamp_ntz")
    cutoff = F.lit("2024-01-09 00:00:00").cast("timestamp_ntz")
    out = increment.unscored_since(feats, spark, name, cutoff)
    assert sorted(r[0] for r in out.collect()) == [3]
