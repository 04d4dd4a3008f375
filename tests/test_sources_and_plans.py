"""Catalog helpers, dictionary joins, scoring idempotence, plan shapes."""

import pytest
from pyspark.sql import functions as F

from leakwatch.operators import dictionary_match
from leakwatch.sources.catalog import append_table, list_tables, overwrite_table, row_counts, table_exists


def test_catalog_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "Action_ID long, v string")
    spark.sql("DROP TABLE IF EXISTS cat_t")
    assert not table_exists(spark, "cat_t")
    overwrite_table(df, "cat_t")
    assert table_exists(spark, "cat_t") and "cat_t" in list_tables(spark)
    append_table(df, "cat_t")
    # Replacing a table from a plan that reads it: checkpoint first.
    overwrite_table(spark.table("cat_t").dropDuplicates(["Action_ID"]), "cat_t", reads_target=True)
    assert {r.table_name: r.n_rows for r in row_counts(spark, ["cat_t"]).collect()} == {"cat_t": 2}


@pytest.mark.parametrize("limit", [10_000, 0])
def test_dictionary_join_paths_agree(spark, limit):
    names = ["client_list.csv", "lunch.pdf", "a+b.txt", "PAYROLL.xlsx", "x", None, "ssn", ""]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, name string")
    kw = spark.createDataFrame([("client",), ("payroll",), ("a+b",), ("ssn",), ("",)], "value string")
    text = F.lower(F.col("name"))
    out = dictionary_match.rows_containing_any(df, text, kw, ["id"], max_broadcast=limit)
    assert sorted(r.id for r in out.collect()) == [0, 2, 3, 6]
    flags = dictionary_match.flag_containing_any(df, text, kw, "hit").collect()
    assert sorted(r.id for r in flags if r.hit) == [0, 2, 3, 6] and len(flags) == len(names)
    assert dictionary_match.rows_containing_any(df, text, kw.limit(0), ["id"], max_broadcast=-1).count() == 0


def test_long_dictionary_agrees_in_all_tiers_and_in_the_feature_build(spark, fixture_dir, monkeypatch):
    from dataclasses import replace

    from leakwatch.operators import features
    from leakwatch.sources.fixture import fixture_rules, upload_events

    words = [f"k{i}z" for i in range(9_990)] + ["client", "payroll", "ssn", "report", "a", "zzzz", "long entry", "x.y", "data", "pass"]
    names = spark.range(0, 3000).selectExpr("id", "concat('file_k', id * 7, CASE WHEN id % 3 = 0 THEN 'z' ELSE 'q' END, '.pdf') AS name")
    kw = spark.createDataFrame([(w,) for w in words], "value string")
    tiers = [sorted(r.id for r in dictionary_match.rows_containing_any(names, F.col("name"), kw, ["id"], max_broadcast=n).collect()) for n in (20_000, 0)]
    assert tiers[0] == tiers[1] == [i for i in range(3000) if i % 3 == 0 and i * 7 < 9_990 or any(w in f"file_k{i * 7}{'z' if i % 3 == 0 else 'q'}.pdf" for w in words[9_990:])]

    rules = replace(fixture_rules(), sensitive_keywords=tuple(fixture_rules().sensitive_keywords) + tuple(words[:200]))
    ev = upload_events(spark, fixture_dir)
    short = features.add_file_features(ev, rules)
    monkeypatch.setattr(features, "MAX_PATTERN_ENTRIES", 10)
    joined = features.add_file_features(ev, rules)
    key = lambda r: r.Action_ID
    assert sorted(short.select(*short.columns).collect(), key=key) == sorted(joined.select(*short.columns).collect(), key=key)


def test_run_scoring_appends_once(spark, fixture_dir):
    from leakwatch.operators.model import BoostParams
    from leakwatch.plans import scoring, training
    from leakwatch.plans.feature_table import feature_table
    from leakwatch.sources.fixture import fixture_rules, upload_events

    ft = feature_table(upload_events(spark, fixture_dir), fixture_rules())
    model = training.train(training.split_features(ft), BoostParams(max_iter=3))
    as_of = ft.agg(F.max("Timestamp")).first()[0]
    spark.sql("DROP TABLE IF EXISTS preds_t")
    n1 = scoring.run_scoring(spark, model, ft, "preds_t", "gbt_test", as_of, hours=48).count()
    n2 = scoring.run_scoring(spark, model, ft, "preds_t", "gbt_test", as_of, hours=48).count()
    assert n1 > 0 and n2 == 0
    t = spark.table("preds_t")
    assert t.columns == [
        "Action_ID", "Timestamp", "AccountDisplayName", "ObjectName", "Target_Domain", "Position", "Risk_Label",
        "predicted", "predicted_prob", "scored_at", "model_version", "event_date",
    ]
    assert t.count() == n1


def test_feature_plan_has_no_python_and_pruned_scan(spark, fixture_dir):
    from leakwatch.plans.feature_table import feature_table
    from leakwatch.sources.fixture import fixture_rules, upload_events

    plan = feature_table(upload_events(spark, fixture_dir), fixture_rules(), strategy="window") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_bucketed_plan_has_no_python(spark, fixture_dir):
    from leakwatch.operators.behaviour import user_behaviour
    from leakwatch.sources.fixture import upload_events

    plan = user_behaviour(upload_events(spark, fixture_dir), strategy="bucketed") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_salted_join_matches_plain_join(spark):
    from leakwatch.operators.skew import salted_join

    left = spark.range(0, 3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    left = left.withColumn("k", F.when(F.col("v") < 1000, F.lit(7)).otherwise(F.col("v")))
    right = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).union(
        spark.createDataFrame([(7, 14)], "k long, w long"))
    hot = spark.createDataFrame([(7,)], "k long")
    for how in ("left", "inner", "left_semi"):
        a = sorted(tuple(r) for r in salted_join(left, right, ["k"], hot, how, salt_buckets=5).collect())
        b = sorted(tuple(r) for r in left.join(right, ["k"], how).collect())
        assert a == b, how
