"""Approximate rolling distinct counts from mergeable sketches.

The exact count (``operators.behaviour``) keeps every (user, domain, second).
Here each (user, hour) keeps one HLL sketch, and a row's window
``[sec - window, sec]`` is the union of

* the sketches of the hours that lie wholly inside it, and
* the two hours at its edges, cut at the second: the current hour up to the
  row, and the first hour from ``sec - window`` on.

So the only error is that of the sketch: a relative standard deviation of
about ``1.04 / sqrt(2 ** lg_k)`` (1.6 % for the default), and none while an
account has few domains. A sketch has at most about ``2 ** lg_k`` bytes.

Memory and skew: sketches are summed on the map side, so a user who holds a
third of all rows sends one sketch per second and task at most. A window over
the hours of a user holds one row per hour, one inside an hour at most 3600
seconds and their edges.

Defined results: a null domain is not counted; a null user is a user; a row
without a time gets null and counts in no window; all rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import SECONDS_7D
from leakwatch.functions.context import epoch_seconds
from leakwatch.operators.behaviour import HOT_KEY_ROWS
from leakwatch.operators.skew import salted_join

APPROX_COL = "user_unique_domains_7d_approx"
LG_K = 12
HOUR = 3600


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Share of the exact count by which a result may be off."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def _hour(t: Column) -> Column:
    return F.floor(t / HOUR).cast("long")


def approx_distinct_window(
    df: DataFrame,
    user: str = S.USER,
    ts: str = S.TS,
    domain: str = S.DOMAIN,
    window_seconds: int = SECONDS_7D,
    lg_k: int = LG_K,
    out_col: str = APPROX_COL,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add ``out_col``: about how many distinct domains the user has in the window."""
    if window_seconds < 2 * HOUR:
        raise ValueError("a window of less than two hours has no whole hour inside")
    S.check_columns(df, [user, ts, domain], "approx_distinct_window")
    some_user = F.lit("" if dict(df.dtypes)[user] == "string" else 0).cast(df.schema[user].dataType)
    # (is-null, value) never is null, so joins and windows need no null-safe handling.
    keyed = df.withColumns({"_hs_t": epoch_seconds(ts), "_hs_un": F.col(user).isNull(), "_hs_u": F.coalesce(F.col(user), some_user)})
    who = ["_hs_un", "_hs_u"]
    sketch = F.hll_sketch_agg(F.col(domain).cast("string"), F.lit(lg_k))
    union = lambda c: F.hll_union_agg(c, False)

    # One sketch per (user, second), read by all that follows.
    seconds = keyed.where(F.col("_hs_t").isNotNull()).groupBy(*who, F.col("_hs_t").alias("t"))
    seconds = seconds.agg(sketch.alias("sk"), F.count("*").alias("n")).checkpoint(eager=True)
    hours = seconds.groupBy(*who, _hour(F.col("t")).alias("h")).agg(union("sk").alias("sk"))
    # Hours wholly inside the window of a row of hour h: the first one starts
    # at or after sec - window for every second of h.
    whole = window_seconds // HOUR
    # No sketch, not an empty one, where there is none: that would have another size.
    over = lambda w: F.when(F.count("sk").over(w) > 0, union("sk").over(w))
    inside = Window.partitionBy(*who).orderBy("h").rangeBetween(1 - whole, -1)
    hours = hours.select(*who, "h", over(inside).alias("mid"))

    # The hour of a row, up to it; and at sec - window, from there on. The
    # second edge reaches over all hours between sec - window and the first
    # whole one, of which there may be two if the window is no whole number of hours.
    to_here = Window.partitionBy(*who, "h").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = seconds.withColumn("h", _hour(F.col("t"))).withColumn("head", union("sk").over(to_here)).select(*who, "t", "h", "head")
    from_there = Window.partitionBy(*who, "h").orderBy(F.desc("t"), "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_whole = lambda t: _hour(t) + 1 - whole
    asked = seconds.select(*who, F.col("t").alias("row_t"), (F.col("t") - window_seconds).alias("t"))
    asked = asked.withColumn("h", F.explode(F.sequence(_hour(F.col("t")), first_whole(F.col("row_t")) - 1)))
    asked = asked.select(*who, "row_t", F.greatest("t", F.col("h") * HOUR).alias("t"), "h", F.lit(None).cast("binary").alias("sk"), F.lit(True).alias("asks"))
    given = seconds.select(*who, F.lit(None).cast("long").alias("row_t"), "t", _hour(F.col("t")).alias("h"), "sk", F.lit(False).alias("asks"))
    tails = asked.unionByName(given).withColumn("tail", over(from_there)).where("asks")
    tails = tails.groupBy(*who, F.col("row_t").alias("t")).agg(F.when(F.count("tail") > 0, union("tail")).alias("tail"))

    parts = here.join(hours, [*who, "h"]).join(tails, [*who, "t"])
    both = lambda a, b: F.hll_union(a, b, False)
    total = F.hll_sketch_estimate(both(both(F.col("head"), F.coalesce("mid", "head")), F.coalesce("tail", "head")))
    result = parts.select(*who, F.col("t").alias("_hs_t"), total.alias(out_col))
    hot = seconds.where(F.col("n") > hot_rows).select(*who, F.col("t").alias("_hs_t"))
    return salted_join(keyed, result, [*who, "_hs_t"], hot, "left").select(*df.columns, out_col)
