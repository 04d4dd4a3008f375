"""Rolling windows: the FIXTURES.md §4 table, and both strategies against a
brute-force reference on random data."""

import datetime as dt
import random

import pytest

from leakwatch.operators.behaviour import user_behaviour

T0 = dt.datetime(2024, 1, 1)

# seconds, domain, count 24h, distinct 7d, first time
EXPECTED = [
    (0, "A", 2, 2, 1),
    (0, "B", 2, 2, 1),
    (86400, "A", 3, 2, 0),
    (86401, None, 2, 2, 1),
    (604800, "C", 2, 3, 1),
    (604800, "C", 2, 3, 1),
    (691201, "B", 1, 2, 0),
]


def _frame(spark, rows):
    data = [(i, "u1", T0 + dt.timedelta(seconds=s), d) for i, (s, d, *_) in enumerate(rows)]
    return spark.createDataFrame(data, "Action_ID long, AccountDisplayName string, Timestamp timestamp_ntz, "
                                       "Target_Domain string")


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_fixture_window_table(spark, strategy):
    out = user_behaviour(_frame(spark, EXPECTED), strategy=strategy).orderBy("Action_ID").collect()
    got = [(r["user_upload_count_24h"], r["user_unique_domains_7d"], r["is_first_time_domain"]) for r in out]
    assert got == [(c, d, f) for _, _, c, d, f in EXPECTED]


def _brute(rows, count_s, dist_s):
    out = []
    for i, (u, s, d) in enumerate(rows):
        same = [(s2, d2) for (u2, s2, d2) in rows if u2 == u]
        cnt = sum(1 for s2, _ in same if s - count_s <= s2 <= s)
        dist = len({d2 for s2, d2 in same if s - dist_s <= s2 <= s and d2 is not None})
        first = int(not any(s2 < s and d2 == d for s2, d2 in same))
        out.append((i, cnt, dist, first))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_strategies_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(400):
        u = rnd.choice(["a", "b", "c"])  # few users: heavy groups
        s = rnd.randint(0, 20 * 86400) // rnd.choice([1, 600, 3600])
        d = rnd.choice(["x", "y", "z", "w", None])
        rows.append((u, s, d))
    data = [(i, u, T0 + dt.timedelta(seconds=s), d) for i, (u, s, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "Action_ID long, AccountDisplayName string, Timestamp timestamp_ntz, "
                                     "Target_Domain string")
    expected = _brute(rows, 3600 * 5, 86400 * 2)
    for strategy, bucket in [("window", 3600), ("bucketed", 3600), ("bucketed", 7)]:
        out = user_behaviour(df, count_seconds=3600 * 5, distinct_seconds=86400 * 2, strategy=strategy,
                             bucket_seconds=bucket).orderBy("Action_ID").collect()
        got = [(r["Action_ID"], r["user_upload_count_24h"], r["user_unique_domains_7d"], r["is_first_time_domain"])
               for r in out]
        assert got == expected, (strategy, bucket)


def test_auto_picks_bucketed_for_heavy_user(spark):
    rows = [(s, "A", 0, 0, 0) for s in range(0, 50)]
    df = _frame(spark, rows)
    a = user_behaviour(df, strategy="auto", max_user_rows=10).orderBy("Action_ID").collect()
    b = user_behaviour(df, strategy="window").orderBy("Action_ID").collect()
    assert [r["user_upload_count_24h"] for r in a] == [r["user_upload_count_24h"] for r in b]


def test_one_exchange_for_three_windows(spark, fixture_dir):
    from leakwatch.sources.fixture import upload_events

    ev = upload_events(spark, fixture_dir)
    plan = user_behaviour(ev, strategy="window")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


SCHEMA = "Action_ID long, AccountDisplayName string, Timestamp timestamp_ntz, Target_Domain string, Note string"


def test_strategies_agree_on_null_users_times_and_domains(spark):
    rows = [("u", 0, "A"), ("u", 10, None), ("u", None, "A"), (None, None, None), (None, 5, "A"), (None, 6, "A"),
            (None, 6, None), ("u", 86400, "A"), ("u", 90000, "B"), ("", 6, "A"), ("u", None, "B")]
    data = [(i, u, None if s is None else T0 + dt.timedelta(seconds=s), d, "n") for i, (u, s, d) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    a = user_behaviour(df, strategy="window")
    b = user_behaviour(df, strategy="bucketed")
    assert a.columns == b.columns == df.columns + ["user_upload_count_24h", "user_unique_domains_7d", "is_first_time_domain"]
    assert sorted(a.collect(), key=lambda r: r.Action_ID) == sorted(b.collect(), key=lambda r: r.Action_ID)
    got = {r.Action_ID: tuple(r)[5:] for r in a.collect()}
    assert got[2] == got[3] == got[10] == (None, None, None)
    assert got[4] == (1, 1, 1) and got[5] == (3, 1, 0) and got[9] == (1, 1, 1)


def test_many_domains_in_a_second_make_one_row_a_second(spark):
    from leakwatch.operators.behaviour import second_deltas

    deltas = spark.range(0, 5000).selectExpr("false AS un", "'u' AS uv", "id % 40 AS t", "1L AS dc", "1L AS dd")
    out = second_deltas(deltas, ["un", "uv"], 10)
    assert max(r["count"] for r in out.groupBy("un", "uv", "_lw_pb").count().collect()) <= 10
    rows = [(i, "u", T0 + dt.timedelta(seconds=i % 40), f"d{i % 300}", "n") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: r.Action_ID
    kw = dict(count_seconds=7, distinct_seconds=11)
    assert sorted(user_behaviour(df, strategy="window", **kw).collect(), key=key) == sorted(
        user_behaviour(df, strategy="bucketed", bucket_seconds=10, **kw).collect(), key=key)


def test_hot_key_salting_keeps_results(spark):
    # One (user, domain, second) key holds a third of the rows.
    rows = [(0, "A")] * 60 + [(s, "AB"[s % 2]) for s in range(1, 121)]
    df = _frame(spark, [(s, d, 0, 0, 0) for s, d in rows])
    cols = ["Action_ID", "user_upload_count_24h", "user_unique_domains_7d", "is_first_time_domain"]
    salted = user_behaviour(df, strategy="bucketed", hot_rows=10, salt_buckets=4)
    plain = user_behaviour(df, strategy="window")
    assert sorted(salted.select(*cols).collect()) == sorted(plain.select(*cols).collect())
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_sk_salt" in plan
