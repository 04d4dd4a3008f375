"""Structured Streaming forms of the daily ingest and scoring runs.

Both read new files as a stream, run a micro-batch with ``foreachBatch`` and
append only keys the target table does not hold yet, so a replayed batch
(at-least-once delivery after a failure) appends nothing twice. With
``trigger(availableNow=True)`` a scheduled run processes everything new and
stops, which is what a daily job needs. Stream progress lives in the given
``checkpoint_location``, which must be the same for every run of a stream (a
folder of the application would start each run from the first file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leakwatch import schemas as S
from leakwatch.operators.increment import append_new
from leakwatch.operators.model import RiskModel
from leakwatch.plans.scoring import score_events


def read_new_files(spark: SparkSession, source_dir: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A stream over the files that land in ``source_dir`` (explicit schema)."""
    return spark.readStream.schema(schema).format(fmt).load(source_dir)


def dedupe_stream(stream: DataFrame, key: str = S.ID, ts: str = S.TS, delay: str = "1 day") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other
    (state is bounded by the watermark).

    Optional for ``ingest_stream``: each micro-batch already goes through
    ``append_new`` (map-side de-duplication, anti-join against the target),
    which is idempotent across batches on its own. This operator is for sinks
    without such a key check; as any stateful operator it groups by key.

    Watermarks need a zoned timestamp; the wall-clock column is read as UTC
    (the session zone) into a helper column that is dropped afterwards.
    """
    event_time = "_event_time"
    with_time = stream.withColumn(event_time, F.col(ts).cast("timestamp"))
    return with_time.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]).drop(event_time)


def ingest_stream(
    spark: SparkSession,
    stream: DataFrame,
    target_table: str,
    checkpoint_location: str,
    key: str = S.ID,
    available_now: bool = True,
) -> StreamingQuery:
    """Append each micro-batch's new keys to ``target_table``."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        append_new(spark, batch, target_table, key)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def scoring_stream(
    spark: SparkSession,
    features: DataFrame,
    model: RiskModel,
    predictions_table: str,
    model_version: str,
    scored_at,
    checkpoint_location: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Score each micro-batch of feature rows and append unseen ids."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        append_new(spark, score_events(model, batch, model_version, scored_at), predictions_table)

    writer = features.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
