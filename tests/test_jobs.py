"""The daily jobs end to end on the smallest fixture."""

import json

from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.model import BoostParams
from leakwatch.plans import jobs
from leakwatch.sources.catalog import overwrite_table
from leakwatch.sources.fixture import fixture_rules, upload_events


def test_daily_flow(spark, fixture_dir, tmp_path):
    ev = upload_events(spark, fixture_dir)
    for t in ("ev_v1", "ev_v2", "ev_v2_rejects", "features_t", "predictions_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    overwrite_table(ev.where("Action_ID < 400"), "ev_v1")
    overwrite_table(ev.where("Action_ID >= 400"), "ev_v2")

    # Ingest: text timestamps, one repeated id, one bad row, two rows without ids.
    batch = spark.createDataFrame(
        [(999, "2024-01-31T10:00:00Z", "upload", "x.csv", "d.example", "User_1", "Analyst", 0),
         (5000, "2024-01-31T11:00:00Z", "upload", "client.pdf", "drop.files.example", "User_1", "Analyst", 1),
         (5001, "not a time", "upload", "y.csv", "d.example", "User_2", "Analyst", 0)],
        "Action_ID long, Timestamp string, ActionType string, ObjectName string, Target_Domain string, "
        "AccountDisplayName string, Position string, Risk_Label long",
    )
    assert jobs.ingest_job(spark, batch, "ev_v2") == 1
    assert jobs.ingest_job(spark, batch, "ev_v2") == 0
    (reject,) = spark.table(jobs.rejects_table("ev_v2")).collect()  # once, as it came, with the reason
    raw = json.loads(reject.raw)
    assert (raw["Action_ID"], raw["Timestamp"], reject.reason, reject.n_rows) == ("5001", "not a time", "time not readable", 1)
    no_ids = batch.drop("Action_ID").where("ObjectName != 'y.csv'")
    assert jobs.ingest_job(spark, no_ids, "ev_v2") == 2
    ids = sorted(r[0] for r in spark.table("ev_v2").where("Action_ID > 5000").select("Action_ID").collect())
    assert ids == [5001, 5002]

    n = jobs.feature_job(spark, ["ev_v1", "ev_v2"], "features_t", fixture_rules())
    assert n == spark.table("features_t").count() > 0
    assert spark.table("features_t").columns == [*S.FEATURE_TABLE_COLUMNS, "event_date"]

    path = str(tmp_path / "model")
    report = jobs.training_job(spark, "features_t", path, BoostParams(max_iter=5))
    assert report["auc_roc"].first()[0] > 0.6

    as_of = spark.table("features_t").agg(F.max("Timestamp")).first()[0]
    first = jobs.scoring_job(spark, "features_t", path, "predictions_t", "gbt_v1", as_of, hours=24).first()
    n1 = spark.table("predictions_t").count()
    assert first["n_scored"] == n1 > 0
    more = jobs.scoring_job(spark, "features_t", path, "predictions_t", "gbt_v1", as_of, hours=72).first()
    n2 = spark.table("predictions_t").count()
    assert more["n_scored"] == n2 - n1 > 0  # the summary is of this run's rows alone
    again = jobs.scoring_job(spark, "features_t", path, "predictions_t", "gbt_v1", as_of, hours=72)
    assert again.count() == 0 and spark.table("predictions_t").count() == n2

    path_b = str(tmp_path / "model_b")
    jobs.training_job(spark, "features_t", path_b, BoostParams(max_iter=2, max_depth=2))
    cmp = jobs.comparison_job(spark, "features_t", ("deep", path), ("shallow", path_b)).collect()
    assert [r.metric for r in cmp][0] == "AUC-ROC" and len(cmp) == 6


def test_every_row_is_taken_rejected_or_a_repeat(spark):
    for t in ("counted_t", "counted_t_rejects"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    times = ["2024-01-01T00:00:00.123Z", "2024-01-01T00:00:00.5+01:00", "", None, "2024-13-01T00:00:00Z", "2024-01-01T00:00:01Z"]
    rows = [(i if i != 5 else None, t, "upload", "a.csv", "x.example", "u", "p", 0) for i, t in enumerate(times)]
    rows += [(0, times[0], "upload", "a.csv", "x.example", "u", "p", 0)]
    batch = spark.createDataFrame(rows, "Action_ID long, Timestamp string, ActionType string, ObjectName string, "
                                        "Target_Domain string, AccountDisplayName string, Position string, Risk_Label long")
    assert jobs.ingest_job(spark, batch, "counted_t") == 2
    rejects = spark.table("counted_t_rejects").collect()
    assert sorted(r.reason for r in rejects) == ["no id", "no time", "time not readable", "time not readable"]
    assert len(rows) == 2 + len(rejects) + 1
    got = {r.Action_ID: r.Timestamp.microsecond for r in spark.table("counted_t").collect()}
    assert got == {0: 123000, 1: 500000}


def test_rows_to_batch_ingest_converts_offsets(spark):
    import datetime as dt

    from leakwatch.sources.catalog import rows_to_batch

    spark.sql("DROP TABLE IF EXISTS ingest_offsets_t")
    batch = rows_to_batch(spark, [
        (1, "2024-03-01T10:00:00+02:00", "upload", "a.csv", "x.example", "User_1", "Analyst", 0),
        (2, "2024-03-01T10:00:00Z", "upload", "b.csv", "x.example", "User_1", "Analyst", 0),
    ])
    assert jobs.ingest_job(spark, batch, "ingest_offsets_t") == 2
    got = {r.Action_ID: r.Timestamp for r in spark.table("ingest_offsets_t").collect()}
    assert got == {1: dt.datetime(2024, 3, 1, 8, 0, 0), 2: dt.datetime(2024, 3, 1, 10, 0, 0)}


EVENT = ("Action_ID long, Timestamp string, ActionType string, ObjectName string, Target_Domain string, "
         "AccountDisplayName string, Position string, Risk_Label long")


def _rejected(spark, target):
    return spark.table(jobs.rejects_table(target)).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def test_equal_bad_rows_replays_and_other_columns(spark):
    for t in ("kept_t", "kept_t_rejects"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    bad = (7, "never", "upload", "a.csv", "x.example", "u", "p", 0)
    good = lambda i: (i, f"2024-01-0{i}T00:00:00Z", "upload", "a.csv", "x.example", "u", "p", 0)
    first = spark.createDataFrame([good(1), bad, bad, good(1)], EVENT)
    assert jobs.ingest_job(spark, first, "kept_t") == 1 and _rejected(spark, "kept_t") == 2
    # The same batch again, its rows in another order: nothing is added.
    assert jobs.ingest_job(spark, first.orderBy(F.desc("Timestamp")), "kept_t") == 0 and _rejected(spark, "kept_t") == 2
    # An equal bad row in another batch is a row of its own.
    second = spark.createDataFrame([good(2), bad], EVENT)
    assert jobs.ingest_job(spark, second, "kept_t", batch_id="day 2") == 1 and _rejected(spark, "kept_t") == 3
    assert jobs.ingest_job(spark, second, "kept_t", batch_id="day 2") == 0 and _rejected(spark, "kept_t") == 3
    # One column more, one less.
    more = spark.createDataFrame([(*good(3), "new"), (*bad, "seen")], EVENT + ", Device string")
    assert jobs.ingest_job(spark, more, "kept_t") == 1 and _rejected(spark, "kept_t") == 4
    assert {json.loads(r.raw).get("Device") for r in spark.table("kept_t_rejects").collect()} == {None, "seen"}
    less = spark.createDataFrame([good(4), bad], EVENT).drop("Position")
    assert jobs.ingest_job(spark, less, "kept_t") == 1 and _rejected(spark, "kept_t") == 5
    no_time = spark.createDataFrame([good(5), bad], EVENT).drop("Timestamp")
    assert jobs.ingest_job(spark, no_time, "kept_t") == 0 and _rejected(spark, "kept_t") == 7
    rows = {r.Action_ID: r.Position for r in spark.table("kept_t").collect()}
    assert rows == {1: "p", 2: "p", 3: "p", 4: None}
    plan = spark.table("kept_t_rejects").where("batch_id = 'day 2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
