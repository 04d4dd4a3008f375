"""Intermediate tables in the folder that driver and executors share, and
session settings that hold for one step only."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root}/{name.replace(' ', '_')}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str | None = None, dictionary: bool = True) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder, and read
    again; without ``dictionary`` where most values differ."""
    path = shared_path(df.sparkSession, name)
    options = {"parquet.enable.dictionary": str(dictionary).lower()} | ({"compression": codec} if codec else {})
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the folder of a ``written`` table that is not needed any more."""
    for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this process has made."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Arrow batches of at most so many rows and about so many bytes for the
    jobs that run inside, whose shuffle files go as soon as they have ended;
    the session is left as it was."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(size),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
