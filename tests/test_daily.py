"""Dated tables and the feature table by daily increments."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators import increment
from leakwatch.plans import daily
from leakwatch.plans.feature_table import feature_table
from leakwatch.sources.catalog import append_table
from leakwatch.sources.dated import append_dated, is_dated, overwrite_dated, overwrite_days, since
from leakwatch.sources.fixture import fixture_rules


def rows_of(n=400, days=12, seed=9):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        t = start + dt.timedelta(seconds=r.choice([r.randrange(days * 86400), 86400 * r.randrange(days), 86400 * r.randrange(1, days) - 1]))
        out.append((i, t if r.random() > 0.03 else None, "upload", r.choice(["a.csv", "b.pdf.zip"]), r.choice(["x.example", "y.example", "z.example", f"w{r.randrange(9)}"]),
                    r.choice(["u", "v"]), "Analyst", i % 2))
    # Nulls in the key columns: counted in windows, dropped from the table.
    return out + [(1000 + k, start + dt.timedelta(days=k), "upload", "a.csv", r.choice([None, "x.example"]), r.choice([None, "u"]), "Analyst", 0) for k in range(days)]


def tables(spark, *names):
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def compare(got, want):
    return sorted(map(tuple, got.select(*S.FEATURE_TABLE_COLUMNS).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_daily_runs_equal_one_full_build(spark):
    tables(spark, "d_events", "d_ft", "d_ft_first_uses")
    ev = spark.createDataFrame(rows_of(), S.UPLOAD_EVENT_SCHEMA)
    overwrite_dated(ev, "d_events")
    days = [f"2024-01-{k:02d}" for k in range(1, 13)]
    for day in days:
        daily.daily_job(spark, "d_events", "d_ft", day, fixture_rules())
    want = feature_table(ev, fixture_rules())
    assert compare(spark.table("d_ft"), want)
    # A day that is run again replaces itself.
    before = spark.table("d_ft_first_uses").count()
    daily.daily_job(spark, "d_events", "d_ft", days[6], fixture_rules(), strategy="bucketed")
    assert compare(spark.table("d_ft"), want) and spark.table("d_ft_first_uses").count() == before
    # A late event of an earlier day: that day and those after it again.
    late = spark.createDataFrame([(5000, dt.datetime(2024, 1, 5, 0, 0), "upload", "a.csv", "late.example", "u", "Analyst", 1),
                                  (5001, dt.datetime(2024, 1, 9, 0, 0), "upload", "a.csv", "late.example", "u", "Analyst", 1)], S.UPLOAD_EVENT_SCHEMA)
    append_dated(late, "d_events")
    daily.daily_job(spark, "d_events", "d_ft", days[4], fixture_rules(), last=days[-1])
    assert compare(spark.table("d_ft"), feature_table(ev.unionByName(late), fixture_rules()))


def test_only_the_needed_days_are_read(spark):
    tables(spark, "p_events", "p_pred")
    ev = spark.createDataFrame(rows_of(), S.UPLOAD_EVENT_SCHEMA)
    overwrite_dated(ev, "p_events")
    append_dated(ev.where("Action_ID < 100"), "p_pred")
    cutoff = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    recent = since(spark.table("p_events"), cutoff)
    assert {f.split("event_date=")[1][:10] for f in recent.inputFiles()} >= {"2024-01-10"}
    out = increment.unscored_since(spark.table("p_events"), spark, "p_pred", cutoff)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") == 2
    want = {r[0] for r in ev.where(F.col(S.TS) >= cutoff).collect()} - set(range(100))
    assert {r[S.ID] for r in out.collect()} == want


def test_overwritten_days_and_old_tables(spark):
    tables(spark, "o_days", "o_old")
    ev = spark.createDataFrame(rows_of(), S.UPLOAD_EVENT_SCHEMA)
    overwrite_days(spark, ev, "o_days")
    day = F.to_date(S.TS) == F.to_date(F.lit("2024-01-03"))
    overwrite_days(spark, ev.where(day).limit(1), "o_days")
    assert spark.table("o_days").count() == ev.where(~day | F.col(S.TS).isNull()).count() + 1
    # A table from before, without dates, goes on as it is.
    append_table(ev.where("Action_ID < 10"), "o_old")
    assert increment.append_new(spark, ev, "o_old") == ev.count() - 10
    assert not is_dated(spark.table("o_old"))
