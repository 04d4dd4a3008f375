"""The feature table by daily increments.

A full build reads all history every day. The rolling count and the rolling
distinct count of a day need only the days that its windows reach back to,
which a dated event table prunes to; only the first use of a domain needs all
history, and of that only one row per (user, domain): a carried table of first
uses. A day's run reads its windows' days and the first uses of its own
(user, domain) pairs, and writes the day's features and the day's new first
uses, each as one partition. Days run in order; a day that is run again
replaces itself. An event that arrives for an earlier day changes the days
after it: run that day and those after it again.

The rows equal those of a full build, null users and domains included. Rows
without a time have no day and belong to no increment; the feature table
drops them anyway.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import RiskRules
from leakwatch.operators.behaviour import FIRST_COL
from leakwatch.plans.feature_table import build_features
from leakwatch.sources.catalog import table_exists
from leakwatch.sources.dated import EVENT_DATE, on_days, overwrite_days

_PAIR = [S.USER, S.DOMAIN]


def day_features(events: DataFrame, first_uses: DataFrame | None, day: str, last: str, rules: RiskRules, strategy: str = "auto") -> DataFrame:
    """The feature table's rows of the days ``day`` to ``last``. ``events`` has ``event_date``;
    ``first_uses`` (user, domain, event_date) those of the days before ``day``."""
    reach = max(rules.count_window_seconds, rules.distinct_window_seconds)
    first = dt.date.fromisoformat(day) - dt.timedelta(days=-(-reach // 86400))
    slice_ = on_days(events, first.isoformat(), last).select(*S.UPLOAD_EVENT_COLUMNS)
    rows = build_features(slice_, rules, strategy).where(F.to_date(S.TS) >= F.to_date(F.lit(day)))
    if first_uses is not None:
        # A pair used on an earlier day is not new, whether or not the slice reaches back to it.
        pairs = on_days(events, day, last).select(*_PAIR).distinct()
        old = first_uses.where(F.col(EVENT_DATE) < F.to_date(F.lit(day))).select(*_PAIR)
        same = lambda a, b: F.col(f"{a}.{S.USER}").eqNullSafe(F.col(f"{b}.{S.USER}")) & F.col(f"{a}.{S.DOMAIN}").eqNullSafe(F.col(f"{b}.{S.DOMAIN}"))
        known = old.alias("o").join(pairs.alias("p"), same("o", "p"), "left_semi").distinct().withColumn("_known", F.lit(True))
        rows = rows.alias("r").join(known.alias("k"), same("r", "k"), "left").select("r.*", "_known")
        rows = rows.withColumn(FIRST_COL, F.when(F.col("_known"), F.lit(0)).otherwise(F.col(FIRST_COL)).cast("int")).drop("_known")
    return rows.select(*S.FEATURE_TABLE_COLUMNS)


def new_first_uses(events: DataFrame, first_uses: DataFrame | None, day: str, last: str) -> DataFrame:
    """(user, domain, time) of the pairs that the days have and no day before."""
    found = on_days(events, day, last).groupBy(*_PAIR).agg(F.min(S.TS).alias(S.TS))
    if first_uses is None:
        return found
    old = first_uses.where(F.col(EVENT_DATE) < F.to_date(F.lit(day))).select(*_PAIR)
    same = F.col(f"f.{S.USER}").eqNullSafe(F.col(f"o.{S.USER}")) & F.col(f"f.{S.DOMAIN}").eqNullSafe(F.col(f"o.{S.DOMAIN}"))
    return found.alias("f").join(old.alias("o"), same, "left_anti")


def daily_job(spark: SparkSession, event_table: str, target: str, day: str, rules: RiskRules, last: str | None = None, strategy: str = "auto") -> int:
    """Write ``day`` (or ``day`` to ``last``) of the feature table ``target``
    and of its first uses (``<target>_first_uses``); returns the rows written.
    ``event_table`` is dated."""
    last = last or day
    state = f"{target}_first_uses"
    first_uses = spark.table(state) if table_exists(spark, state) else None
    events = spark.table(event_table)
    # Both targets may be read by the plans that replace a day of them.
    rows = day_features(events, first_uses, day, last, rules, strategy).na.drop(how="any").checkpoint(eager=True)
    uses = new_first_uses(events, first_uses, day, last).checkpoint(eager=True)
    overwrite_days(spark, rows, target)
    overwrite_days(spark, uses, state)
    return rows.count()
