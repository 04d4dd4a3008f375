"""Property test: the skew-proof bucketed plan equals the direct window plan
on random small inputs (random users, seconds, domains, nulls among all three, window lengths and
bucket widths)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from leakwatch.operators.behaviour import user_behaviour

T0 = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 50)), st.sampled_from(["x", "y", "z", None])),
    min_size=1,
    max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, count_s=st.integers(0, 20), dist_s=st.integers(0, 30), bucket=st.integers(1, 9))
def test_bucketed_equals_window(spark, rows, count_s, dist_s, bucket):
    data = [(i, u, None if s is None else T0 + dt.timedelta(seconds=s), d) for i, (u, s, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "Action_ID long, AccountDisplayName string, Timestamp timestamp_ntz, "
                                     "Target_Domain string")
    cols = ["Action_ID", "user_upload_count_24h", "user_unique_domains_7d", "is_first_time_domain"]
    kw = dict(count_seconds=count_s, distinct_seconds=dist_s)
    a = user_behaviour(df, strategy="window", **kw).select(*cols).orderBy("Action_ID").collect()
    b = user_behaviour(df, strategy="bucketed", bucket_seconds=bucket, hot_rows=2, salt_buckets=3, **kw) \
        .select(*cols).orderBy("Action_ID").collect()
    assert a == b
