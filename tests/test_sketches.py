import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from leakwatch.operators.behaviour import user_behaviour
from leakwatch.operators.sketches import APPROX_COL, approx_distinct_window, relative_error

SCHEMA = "id long, AccountDisplayName string, Timestamp timestamp_ntz, Target_Domain string, h string, t int"


def rows_of(n, domains, seed, days=20, users=("a", "b", None)):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        t = start + dt.timedelta(seconds=r.choice([r.randrange(days * 86400), 3600 * r.randrange(days * 24), 3600 * r.randrange(days * 24) + 3599]))
        out.append((i, r.choice(users), t if r.random() > 0.02 else None, r.choice([None, *(f"d{k}" for k in range(domains))]), "clash", 1))
    return out


def exact(rows, window):
    seconds = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp())
    out = {}
    for i, u, t, *_ in rows:
        if t is not None:
            now = seconds(t)
            out[i] = len({d for _, v, s, d, *_ in rows if v == u and s is not None and d is not None and now - window <= seconds(s) <= now})
        else:
            out[i] = None
    return out


@pytest.mark.parametrize("window", [7 * 86400, 2 * 3600, 3 * 3600 + 1, 86400 - 1, 5400 + 7200])
def test_few_domains_are_counted_exactly(spark, window):
    rows = rows_of(300, 25, window)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = approx_distinct_window(df, window_seconds=window)
    assert got.columns == [*df.columns, APPROX_COL]
    assert {r.id: r[APPROX_COL] for r in got.collect()} == exact(rows, window)


def test_many_domains_stay_inside_the_stated_error(spark):
    rows = rows_of(12_000, 9_000, 3, days=9, users=("a",))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    both = approx_distinct_window(user_behaviour(df, strategy="bucketed"), lg_k=10, hot_rows=1)
    off = both.where("Timestamp IS NOT NULL").select((F.abs(F.col(APPROX_COL) / F.col("user_unique_domains_7d") - 1)).alias("e"), "user_unique_domains_7d")
    worst, mean, most = off.agg(F.max("e"), F.avg("e"), F.max("user_unique_domains_7d")).first()
    assert most > 4000 and worst < relative_error(10, 4.5) and mean < relative_error(10, 1.5)


def test_empty_table_and_short_window(spark):
    assert approx_distinct_window(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        approx_distinct_window(spark.createDataFrame([], SCHEMA), window_seconds=3600)
