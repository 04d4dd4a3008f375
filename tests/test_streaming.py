"""Streaming ingest: replays and repeats append nothing twice."""

import datetime as dt
import os

from leakwatch.streaming.incremental import dedupe_stream, ingest_stream, read_new_files


def test_stream_ingest_idempotent(spark, tmp_path):
    src = str(tmp_path / "landing")
    t0 = dt.datetime(2024, 1, 1)
    schema = "Action_ID long, Timestamp timestamp_ntz, v string"
    spark.createDataFrame([(1, t0, "a"), (2, t0, "b"), (2, t0, "b")], schema).write.parquet(os.path.join(src, "f1"))
    table = "stream_ingest_target"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    stream = dedupe_stream(read_new_files(spark, os.path.join(src, "*"), spark.createDataFrame([], schema).schema))
    ckpt = str(tmp_path / "progress")
    q = ingest_stream(spark, stream, table, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert spark.table(table).count() == 2
    # A new file repeating id 2 plus a new id 3.
    spark.createDataFrame([(2, t0, "b"), (3, t0, "c")], schema).write.parquet(os.path.join(src, "f2"))
    stream = dedupe_stream(read_new_files(spark, os.path.join(src, "*"), spark.createDataFrame([], schema).schema))
    q = ingest_stream(spark, stream, table, checkpoint_location=ckpt)
    q.awaitTermination(120)
    assert sorted(r[0] for r in spark.table(table).select("Action_ID").collect()) == [1, 2, 3]


def test_stream_scoring_appends_new_ids_once(spark, tmp_path, fixture_dir):
    from leakwatch.operators.model import BoostParams
    from leakwatch.plans import training
    from leakwatch.plans.feature_table import feature_table
    from leakwatch.sources.fixture import fixture_rules, upload_events
    from leakwatch.streaming.incremental import scoring_stream

    ft = feature_table(upload_events(spark, fixture_dir), fixture_rules())
    model = training.train(training.split_features(ft), BoostParams(max_iter=3))
    landing = str(tmp_path / "features")
    ft.where("Action_ID < 300").write.parquet(os.path.join(landing, "a"))
    table = "stream_scored"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ckpt = str(tmp_path / "progress")

    def run():
        stream = read_new_files(spark, os.path.join(landing, "*"), ft.schema)
        scoring_stream(spark, stream, model, table, "gbt_stream", "2024-02-01 00:00:00",
                       checkpoint_location=ckpt).awaitTermination(120)

    run()
    n1 = spark.table(table).count()
    # Overlapping ids in the next file: only the new ones are appended.
    ft.where("Action_ID >= 200 AND Action_ID < 500").write.parquet(os.path.join(landing, "b"))
    run()
    ids = [r[0] for r in spark.table(table).select("Action_ID").collect()]
    assert n1 == ft.where("Action_ID < 300").count()
    assert len(ids) == len(set(ids)) == ft.where("Action_ID < 500").count()
