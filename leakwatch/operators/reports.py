"""Filters, lookups, orderings and summary aggregates over event, feature and
prediction tables.

Every filter uses typed literals so it reaches the Parquet scan as a pushed
filter; time filters are half-open ranges on the raw column (never a cast of
the column), so they stay pushable and prune row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakwatch import schemas as S


def ts_value(as_of) -> Column:
    """A timestamp literal, or a scalar column (e.g. ``df.agg(max).scalar()``)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def latest_timestamp(df: DataFrame, ts: str = S.TS) -> Column:
    """``max(ts)`` as a scalar subquery column (evaluated once by Spark)."""
    return df.agg(F.max(ts)).scalar()


def flag_equals(df: DataFrame, column: str, value: int) -> DataFrame:
    """Rows whose flag/label/id column equals ``value``."""
    return df.where(F.col(column) == F.lit(value))


def above(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Rows whose numeric column is strictly above ``threshold``."""
    return df.where(F.col(column) > F.lit(threshold))


def name_contains(df: DataFrame, text: str, column: str = S.OBJECT) -> DataFrame:
    """Rows whose file name contains ``text`` literally (e.g. ``.pdf.``)."""
    return df.where(F.col(column).contains(F.lit(text)))


def recent(df: DataFrame, hours: int, as_of, ts: str = S.TS) -> DataFrame:
    """Rows at or after ``as_of - hours`` (inclusive)."""
    cutoff = ts_value(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.where(F.col(ts) >= cutoff)


def on_day(df: DataFrame, day, ts: str = S.TS, order_by: str = S.ID) -> DataFrame:
    """Rows on the calendar day of ``day`` (``[day, day + 1)``), ordered by id."""
    start = F.to_timestamp_ntz(F.date_format(ts_value(day), "yyyy-MM-dd"))
    end = start + F.make_dt_interval(F.lit(1))
    return df.where((F.col(ts) >= start) & (F.col(ts) < end)).orderBy(order_by)


def missed_incidents(pred: DataFrame) -> DataFrame:
    """Predicted safe but labelled risky, highest probability first."""
    return pred.where((F.col("predicted") == 0) & (F.col(S.LABEL) == 1)).orderBy(
        F.col("predicted_prob").desc(), F.col(S.ID).asc()
    )


FLAGGED_COLUMNS = [S.ID, S.USER, S.OBJECT, S.DOMAIN, S.POSITION, "predicted_prob"]


def flagged(pred: DataFrame) -> DataFrame:
    """Predicted risky events, highest probability first (ties by id)."""
    return (
        pred.where(F.col("predicted") == 1)
        .select(*FLAGGED_COLUMNS)
        .orderBy(F.col("predicted_prob").desc(), F.col(S.ID).asc())
    )


def top_k(pred: DataFrame, k: int, score: str = "predicted_prob") -> DataFrame:
    """The ``k`` highest-scored rows (a top-k report: planned as
    TakeOrderedAndProject, each task keeps only its own k best)."""
    return pred.orderBy(F.col(score).desc(), F.col(S.ID).asc()).limit(k)


def by_id(df: DataFrame, action_id: int) -> DataFrame:
    return df.where(F.col(S.ID) == F.lit(action_id).cast("long"))


def label_distribution(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Count and share per label value, from one aggregation."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per label value: the total is a window over that tiny result,
    # so the input is scanned once.
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "n", (F.col("n").cast("double") / total.cast("double")).alias("share"))


def next_id(df: DataFrame, id_col: str = S.ID) -> DataFrame:
    """One row: ``coalesce(max(id), 0) + 1`` (an empty table starts at 1)."""
    return df.agg((F.coalesce(F.max(id_col), F.lit(0).cast("long")) + 1).alias("next_action_id"))


def scoring_summary(pred: DataFrame) -> DataFrame:
    """Per model version: scored, flagged, safe, mean and max probability."""
    return pred.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.sum(F.when(F.col("predicted") == 1, 1).otherwise(0)).cast("long").alias("n_flagged"),
        F.sum(F.when(F.col("predicted") == 0, 1).otherwise(0)).cast("long").alias("n_safe"),
        F.round(F.avg("predicted_prob"), 10).alias("avg_prob"),
        F.max("predicted_prob").alias("max_prob"),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def completeness(df: DataFrame) -> DataFrame:
    """One row: total rows and rows with no null in any column (one pass)."""
    complete = F.lit(True)
    for c in df.columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(complete, 1).otherwise(0)).cast("long").alias("n_complete"),
    )
