"""Incremental scoring: events of the last N hours not yet scored → model →
appended to the predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators import reports
from leakwatch.operators.increment import unscored_since
from leakwatch.operators.model import RiskModel, predict
from leakwatch.sources.dated import append_dated


def score_events(model: RiskModel, events: DataFrame, model_version: str, scored_at) -> DataFrame:
    """Score rows and shape them like the predictions table (11 columns)."""
    pred = predict(model, events)
    return pred.withColumns(
        {
            "scored_at": F.lit(str(scored_at)).cast("timestamp_ntz"),
            "model_version": F.lit(model_version),
        }
    ).select(*S.PREDICTION_COLUMNS)


def pending(spark: SparkSession, features: DataFrame, predictions_table: str, hours: int, as_of) -> DataFrame:
    """Rows of the last ``hours`` (inclusive) not yet in the predictions table.

    Both sides are cut at the same bound, so the anti-join reads only the
    recent slice of the predictions table (see ``unscored_since``).
    """
    cutoff = reports.ts_value(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return unscored_since(features, spark, predictions_table, cutoff)


def run_scoring(
    spark: SparkSession,
    model: RiskModel,
    features: DataFrame,
    predictions_table: str,
    model_version: str,
    as_of,
    hours: int = 24,
) -> DataFrame:
    """Score what is pending, append it, and return the rows appended. The
    predictions table is dated (``sources.dated``).

    The batch is checkpointed before the append because its plan reads the
    table it appends to, and what is returned is that copy: nothing reads the
    table again. Running again with the same input appends 0 rows.
    """
    batch = score_events(model, pending(spark, features, predictions_table, hours, as_of), model_version, as_of)
    batch = batch.checkpoint(eager=True)
    if not batch.isEmpty():
        append_dated(batch, predictions_table)
        spark.catalog.refreshTable(predictions_table)
    return batch
