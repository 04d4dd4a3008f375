"""Catalog tables: exists / list / read / overwrite / append.

Tables are Parquet-backed managed tables. Writers never read and overwrite
the same table in one plan (Spark rejects it); ``overwrite_table`` checkpoints
first when asked to replace a table its input depends on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder/file by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def overwrite_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                    reads_target: bool = False) -> None:
    """Replace ``name`` with ``df``.

    ``reads_target=True`` cuts the lineage with a reliable checkpoint (in the
    shared ``spark.checkpoint.dir``) before the old files are dropped.
    """
    if reads_target:
        df = df.checkpoint(eager=True)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Append ``df`` to ``name`` (created on first use)."""
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """One row per table with its row count, computed in one job."""
    parts = None
    for name in names:
        one = spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        parts = one if parts is None else parts.unionByName(one)
    return parts


RAW_BATCH_SCHEMA = (
    "Action_ID long, Timestamp string, ActionType string, ObjectName string, Target_Domain string, "
    "AccountDisplayName string, Position string, Risk_Label long"
)


def rows_to_batch(spark: SparkSession, rows: list[tuple], schema: str = RAW_BATCH_SCHEMA) -> DataFrame:
    """A small batch of locally produced rows (e.g. an upstream export) as a
    typed DataFrame; timestamps stay text until the ingest job parses them."""
    return spark.createDataFrame(rows, schema)
