"""Per-user behaviour windows: rolling upload count, rolling distinct
destinations, first use of a destination.

Definitions (``sec`` = whole epoch seconds of the event):

* ``user_upload_count_24h``: rows of the same user with ``sec`` in
  ``[sec - 86400, sec]``, the row itself and same-second peers included.
* ``user_unique_domains_7d``: distinct non-null domains of the same user with
  ``sec`` in ``[sec - 604800, sec]``.
* ``is_first_time_domain``: 1 when no earlier second of the same user holds
  the same domain (null is its own domain); all rows of the earliest second
  get 1 (rank semantics).
* A null user is a user of its own. A row without a time lies in no window:
  it gets null in all three columns and counts in no other row's window.

Two strategies give the same rows and the same column order (the input's,
then the three columns):

``"bucketed"`` (skew-proof). A plain window partitioned by user puts
all of one user's history into one task; one busy account (or bot) can hold a
large share of all rows. Here no task ever holds more than a bounded slice
of time:

1. Rows are compacted to distinct (user, domain, second) with a count
   (partial aggregation on the map side).
2. For the distinct count, each domain occurrence ``s`` opens an "active"
   interval that ends at ``min(s + W, next occurrence)``; the next occurrence
   is found inside (user, domain, W+1-second bucket) windows plus a tiny
   per-bucket table, so only the following bucket is ever needed. This
   compact table is checkpointed once (three branches read it).
3. Both measures become running sums of +/- deltas per user over time. The
   deltas are first summed to one row per (user, second), so however many
   domains an account uses in a second, a time bucket holds at most
   ``bucket_seconds`` rows. The running sum is a window inside each (user,
   bucket) plus a per-bucket offset from a (user, bucket) totals table.
4. Results per (user, second) join the compact table, and its (user, domain,
   second) keys the rows. Keys proven hot by the compaction counts are salted:
   their rows spread over ``salt_buckets`` tasks, their single result row is
   repeated per salt.

``"window"``: the direct formulation with three window functions over
(user) and (user, domain); one shuffle, but a user's whole history is one
group, and Spark re-aggregates a sliding RANGE frame for every row (cost
rows x frame). Only for data where per-user volume is known to be small.

``"auto"`` (default): one cheap job (partial aggregation of per-user counts)
proves the largest user holds at most ``max_user_rows`` rows; then the
single-shuffle window plan is used, otherwise the bucketed plan. This is the
same "check the size, with another way beyond it" rule used for broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import SECONDS_7D, SECONDS_24H
from leakwatch.functions.context import epoch_seconds
from leakwatch.operators.skew import SALT_BUCKETS, salted_join

COUNT_COL = "user_upload_count_24h"
DISTINCT_COL = "user_unique_domains_7d"
FIRST_COL = "is_first_time_domain"

# A (user, domain, second) key with more rows than this is salted in the
# final join; there can be at most total_rows / HOT_KEY_ROWS such keys.
HOT_KEY_ROWS = 1_000_000


def user_behaviour(
    df: DataFrame,
    user: str = S.USER,
    ts: str = S.TS,
    domain: str = S.DOMAIN,
    count_seconds: int = SECONDS_24H,
    distinct_seconds: int = SECONDS_7D,
    strategy: str = "auto",
    bucket_seconds: int = 3600,
    max_user_rows: int = 2000,
    hot_rows: int = HOT_KEY_ROWS,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Add the three behaviour columns to ``df`` (all rows kept)."""
    S.check_columns(df, [user, ts, domain], "user_behaviour")
    if strategy == "auto":
        strategy = "window" if largest_group(df, [user]) <= max_user_rows else "bucketed"
    if strategy == "window":
        return _window_strategy(df, user, ts, domain, count_seconds, distinct_seconds)
    if strategy != "bucketed":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _bucketed_strategy(df, user, ts, domain, count_seconds, distinct_seconds, bucket_seconds,
                              hot_rows, salt_buckets)


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest group (one small aggregate job)."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()
    return int(row[0] or 0)


def _window_strategy(df, user, ts, domain, count_seconds, distinct_seconds):
    sec = "_lw_sec"
    out = df.withColumn(sec, epoch_seconds(ts))
    by_time = F.col(sec).asc_nulls_last()
    w_count = Window.partitionBy(user).orderBy(by_time).rangeBetween(-count_seconds, 0)
    w_dist = Window.partitionBy(user).orderBy(by_time).rangeBetween(-distinct_seconds, 0)
    w_first = Window.partitionBy(user, domain).orderBy(by_time)
    timed = F.col(sec).isNotNull()
    return out.withColumns(
        {
            COUNT_COL: F.when(timed, F.count(F.lit(1)).over(w_count).cast("long")),
            DISTINCT_COL: F.when(timed, F.size(F.collect_set(domain).over(w_dist)).cast("long")),
            FIRST_COL: F.when(timed, (F.rank().over(w_first) == 1).cast("int")),
        }
    ).select(*df.columns, COUNT_COL, DISTINCT_COL, FIRST_COL)


def _bucket(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long")


def _bucketed_strategy(df, user, ts, domain, count_seconds, distinct_seconds, bucket_seconds,
                       hot_rows=HOT_KEY_ROWS, salt_buckets=SALT_BUCKETS):
    if bucket_seconds <= 0:
        raise ValueError("bucket_seconds must be positive")
    sec, un, uv, dn, dv = "_lw_sec", "_lw_un", "_lw_uv", "_lw_dn", "_lw_dv"
    # Null users and null domains are groups of their own; (is-null, value)
    # is an exact, never-null key, so joins need no null-safe handling.
    some_user = F.lit("" if dict(df.dtypes)[user] == "string" else 0).cast(df.schema[user].dataType)
    keyed = df.withColumns(
        {
            sec: epoch_seconds(ts),
            un: F.col(user).isNull(),
            uv: F.coalesce(F.col(user), some_user),
            dn: F.col(domain).isNull(),
            dv: F.coalesce(F.col(domain), F.lit("")),
        }
    )
    who = [un, uv]
    occ_key = [*who, dn, dv]

    # 1. Compact to distinct (user, domain, second).
    occ = keyed.where(F.col(sec).isNotNull()).groupBy(*occ_key, sec).agg(F.count(F.lit(1)).alias("_lw_n"))

    # 2. Next occurrence of the same domain (only needed within the distinct
    #    window, so buckets of distinct_seconds + 1 reach it in one step).
    width = distinct_seconds + 1
    occ = occ.withColumn("_lw_b", _bucket(F.col(sec), width))
    w_local = Window.partitionBy(*occ_key, "_lw_b").orderBy(sec)
    occ = occ.withColumns({"_lw_nx": F.lead(sec).over(w_local), "_lw_rn": F.row_number().over(w_local)})
    per_bucket = occ.groupBy(*occ_key, "_lw_b").agg(F.min(sec).alias("_lw_bmin"))
    w_buckets = Window.partitionBy(*occ_key).orderBy("_lw_b")
    per_bucket = per_bucket.select(
        *occ_key,
        "_lw_b",
        F.lead("_lw_bmin").over(w_buckets).alias("_lw_nbmin"),
        (F.row_number().over(w_buckets) == 1).alias("_lw_fb"),
    )
    nxt = F.coalesce(F.col("_lw_nx"), F.col("_lw_nbmin"))
    first = ((F.col("_lw_rn") == 1) & F.col("_lw_fb")).cast("int")
    # Three branches below read this compact table: materialise it
    # once in the shared checkpoint folder (also cuts the lineage).
    occ = (
        occ.join(per_bucket, [*occ_key, "_lw_b"])
        .select(*occ_key, sec, "_lw_n", nxt.alias("_lw_next"), first.alias("_lw_first"))
        .checkpoint(eager=True)
    )
    # 3. Deltas: (+n at s, -n after the count window), (+1 at s, -1 when the
    #    domain stops being active), summed to one row per (user, second).
    s = F.col(sec)
    n = F.col("_lw_n")
    active = F.when(F.col(dn), F.lit(0)).otherwise(F.lit(1))
    count_end = s + F.lit(count_seconds + 1)
    dist_end = F.least(s + F.lit(distinct_seconds + 1), F.coalesce(F.col("_lw_next"), s + F.lit(distinct_seconds + 1)))

    def delta(t, dc, dd):
        return F.struct(t.cast("long").alias("t"), dc.cast("long").alias("dc"), dd.cast("long").alias("dd"))

    deltas = second_deltas(
        occ.select(*who, F.inline(F.array(delta(s, n, active), delta(count_end, -n, F.lit(0)), delta(dist_end, F.lit(0), -active)))),
        who,
        bucket_seconds,
    )

    # 4. Running sums: inside each (user, time bucket) plus the bucket offset.
    w_run = Window.partitionBy(*who, "_lw_pb").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = deltas.withColumns({"_lw_cc": F.sum("dc").over(w_run), "_lw_cd": F.sum("dd").over(w_run)})
    totals = deltas.groupBy(*who, "_lw_pb").agg(F.sum("dc").alias("_lw_tc"), F.sum("dd").alias("_lw_td"))
    w_off = Window.partitionBy(*who).orderBy("_lw_pb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *who,
        "_lw_pb",
        F.coalesce(F.sum("_lw_tc").over(w_off), F.lit(0)).alias("_lw_oc"),
        F.coalesce(F.sum("_lw_td").over(w_off), F.lit(0)).alias("_lw_od"),
    )
    seconds = running.join(offsets, [*who, "_lw_pb"]).select(
        *who,
        F.col("t").alias(sec),
        (F.col("_lw_cc") + F.col("_lw_oc")).cast("long").alias(COUNT_COL),
        (F.col("_lw_cd") + F.col("_lw_od")).cast("long").alias(DISTINCT_COL),
    )
    result = occ.join(seconds, [*who, sec]).select(
        *occ_key, sec, COUNT_COL, DISTINCT_COL, F.col("_lw_first").alias(FIRST_COL)
    )

    # 5. Back to the rows: one row of ``result`` per (user, domain, second).
    joined = _join_back(keyed, result, occ, [*occ_key, sec], hot_rows, salt_buckets)
    return joined.select(*df.columns, COUNT_COL, DISTINCT_COL, FIRST_COL)


def second_deltas(deltas: DataFrame, who: list[str], bucket_seconds: int) -> DataFrame:
    """Deltas summed to one row per (user, second), with the time bucket: a
    bucket holds at most ``bucket_seconds`` rows, whatever the traffic."""
    summed = deltas.groupBy(*who, "t").agg(F.sum("dc").alias("dc"), F.sum("dd").alias("dd"))
    return summed.withColumn("_lw_pb", _bucket(F.col("t"), bucket_seconds))


def _join_back(rows: DataFrame, result: DataFrame, occ: DataFrame, keys: list[str], hot_rows: int,
               salt_buckets: int) -> DataFrame:
    """Equi-join ``rows`` to the one-row-per-key ``result``, salting hot keys.

    The compaction table already knows each key's row count, so the keys with
    more than ``hot_rows`` rows are known before the join (see
    ``operators.skew.salted_join``).
    """
    hot = occ.where(F.col("_lw_n") > hot_rows).select(*keys)
    return salted_join(rows, result, keys, hot, "left", salt_buckets)
