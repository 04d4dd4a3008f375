"""Tables partitioned by event date.

The last column, ``event_date``, is the day of the row's event time and the
table's partition, so a run over the last hours lists and reads only the
folders of those days. A day can be written again on its own: dynamic
partition overwrite replaces the days that the rows have and no others. Rows
without a time are in a partition of their own (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.sources.catalog import append_table, overwrite_table, table_exists

EVENT_DATE = "event_date"


def with_date(df: DataFrame, ts: str = S.TS) -> DataFrame:
    return df.withColumn(EVENT_DATE, F.to_date(ts)).select(*[c for c in df.columns if c != EVENT_DATE], EVENT_DATE)


def is_dated(df: DataFrame) -> bool:
    return EVENT_DATE in df.columns


def since(df: DataFrame, cutoff: Column, ts: str = S.TS) -> DataFrame:
    """Rows at or after ``cutoff``; of a dated table only the days from it on are read."""
    out = df.where(F.col(ts) >= cutoff)
    return out.where(F.col(EVENT_DATE) >= F.to_date(cutoff)) if is_dated(df) else out


def on_days(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the days ``first`` to ``last`` (both inclusive) of a dated table."""
    return df.where(F.col(EVENT_DATE).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def append_dated(df: DataFrame, name: str, ts: str = S.TS) -> None:
    """Append to a dated table, which is made on first use; a table from
    before, without dates, stays as it is."""
    spark = df.sparkSession
    if table_exists(spark, name) and not is_dated(spark.table(name)):
        append_table(df, name)
    else:
        append_table(with_date(df, ts), name, partition_by=[EVENT_DATE])


def overwrite_dated(df: DataFrame, name: str, ts: str = S.TS, reads_target: bool = False) -> None:
    """Replace the whole table."""
    overwrite_table(with_date(df, ts), name, partition_by=[EVENT_DATE], reads_target=reads_target)


def overwrite_days(spark: SparkSession, df: DataFrame, name: str, ts: str = S.TS) -> None:
    """Replace the days that ``df`` has rows of; the others stay."""
    dated = with_date(df, ts)
    if not table_exists(spark, name):
        append_table(dated, name, partition_by=[EVENT_DATE])
        return
    mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto heeds the session's mode only
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dated.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(name)
