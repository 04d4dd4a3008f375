"""The daily jobs of the original pipeline, composed from the operators.

* ``feature_job``: event tables (versions unioned by name) → feature table
  (overwrite).
* ``ingest_job``: a batch of raw rows (ISO text timestamps) → parsed, given
  ids after the current maximum when missing, appended without repeats.
* ``training_job``: feature table → stratified split → boosted trees → saved
  model folder + test metrics.
* ``scoring_job``: feature rows of the last N hours not yet scored → model →
  appended to the predictions table; returns the run summary.
* ``comparison_job``: two saved models on the same test rows → metric table
  with the winner per metric.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import RiskRules
from leakwatch.functions.context import parse_timestamp
from leakwatch.operators import metrics, reports
from leakwatch.operators.increment import append_new, assign_ids
from leakwatch.operators.model import BoostParams, load_model, save_model
from leakwatch.plans import scoring, training
from leakwatch.plans.feature_table import feature_table
from leakwatch.sources.catalog import append_table, table_exists
from leakwatch.sources.dated import overwrite_dated


def union_versions(spark: SparkSession, tables: list[str], dedupe_key: str | None = None) -> DataFrame:
    """Union event tables by column name; optionally keep one row per key."""
    frames = [spark.table(t).select(*S.UPLOAD_EVENT_COLUMNS) for t in tables]
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.dropDuplicates([dedupe_key]) if dedupe_key else out


def feature_job(spark: SparkSession, event_tables: list[str], target: str, rules: RiskRules) -> int:
    """Rebuild the feature table from all event versions, dated by event (the
    20 columns and ``event_date``); returns its row count. ``plans.daily``
    builds it day by day."""
    features = feature_table(union_versions(spark, event_tables), rules)
    overwrite_dated(features, target, reads_target=target in event_tables)
    return spark.table(target).count()


def ingest_job(spark: SparkSession, batch: DataFrame, target: str, ts_text_col: str | None = S.TS, batch_id: str | None = None) -> int:
    """Append a batch of raw events; returns the number of rows appended.

    Text timestamps are parsed. Rows whose time does not parse or is missing,
    and rows with a null id, go to ``rejects_table``; every row of the batch is
    in the target, in the rejects, or repeats an id of the batch or the target.
    A batch without an id column gets consecutive ids after the current maximum
    of ``target``. A missing column is null; one more than the event has is
    not appended (a rejected row keeps it).

    A reject has ``raw`` (the whole row as JSON, all values as text), the
    ``reason``, and ``n_rows``, how many rows of the batch are equal to it. Its
    ``batch_id`` partitions the table, so only the batch's own rejects are
    read: a batch that is run again adds none, an equal bad row of another
    batch is kept. Without a ``batch_id`` the batch is known by its content.
    """
    types = {f.name: f.dataType for f in S.UPLOAD_EVENT_SCHEMA}
    raw = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in batch.columns]), {"ignoreNullFields": "false"})
    out = batch.withColumn("_raw", raw)
    text_time = ts_text_col in batch.columns and dict(batch.dtypes)[ts_text_col] == "string"
    empty = F.col(ts_text_col or S.TS).isNull() if (ts_text_col or S.TS) in batch.columns else F.lit(True)
    out = out.withColumn("_empty", empty)
    if text_time:
        out = out.withColumn(ts_text_col, parse_timestamp(ts_text_col))
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in batch.columns and c != S.ID})
    reason = F.when(F.col(S.TS).isNull(), F.when(F.col("_empty"), "no time").otherwise("time not readable"))
    if S.ID in batch.columns:
        reason = F.coalesce(reason, F.when(F.col(S.ID).isNull(), "no id"))
    columns = [c for c in S.UPLOAD_EVENT_COLUMNS if c in out.columns]
    out = out.select(*columns, "_raw", reason.alias("_reason")).checkpoint(eager=True)

    name = rejects_table(target)
    batch_id = batch_id or content_digest(out, "_raw")
    if not (table_exists(spark, name) and not spark.table(name).where(F.col("batch_id") == batch_id).isEmpty()):
        rejects = out.where(F.col("_reason").isNotNull()).groupBy(F.col("_raw").alias("raw"), F.col("_reason").alias("reason"))
        rejects = rejects.agg(F.count("*").alias("n_rows")).withColumn("batch_id", F.lit(batch_id)).checkpoint(eager=True)
        if not rejects.isEmpty():
            append_table(rejects, name, partition_by=["batch_id"])
            spark.catalog.refreshTable(name)
    out = out.where(F.col("_reason").isNull()).drop("_raw", "_reason")
    if S.ID not in out.columns:
        existing = spark.table(target) if table_exists(spark, target) else None
        out = assign_ids(out, existing)
    return append_new(spark, out.select(*S.UPLOAD_EVENT_COLUMNS), target)


def content_digest(df: DataFrame, text_col: str) -> str:
    """Digest of a bag of rows, whatever their order: count, sum and xor of the rows' codes."""
    code = F.xxhash64(text_col)
    row = df.agg(F.count("*"), F.sum(code.cast("decimal(38,0)")), F.bit_xor(code)).first()
    return hashlib.sha256(repr([str(x) for x in row]).encode()).hexdigest()[:32]


def rejects_table(target: str) -> str:
    """Where ``ingest_job`` puts the rows of ``target`` that it cannot take."""
    return f"{target}_rejects"


def training_job(
    spark: SparkSession, features_table: str, model_path: str, params: BoostParams = BoostParams()
) -> dict[str, DataFrame]:
    """Fit on the training split, save the model, return its test metrics."""
    split_df = training.split_features(spark.table(features_table))
    model = training.train(split_df, params)
    save_model(model, model_path)
    return training.evaluate(training.test_predictions(model, split_df))


def scoring_job(
    spark: SparkSession,
    features_table: str,
    model_path: str,
    predictions_table: str,
    model_version: str,
    as_of,
    hours: int = 24,
) -> DataFrame:
    """Score what is new and return the run summary of the appended rows."""
    model = load_model(model_path)
    features = spark.table(features_table)
    return reports.scoring_summary(scoring.run_scoring(spark, model, features, predictions_table, model_version, as_of, hours))


def comparison_job(
    spark: SparkSession, features_table: str, model_a: tuple[str, str], model_b: tuple[str, str]
) -> DataFrame:
    """Compare two saved models ``(name, path)`` on the same held-out rows."""
    split_df = training.split_features(spark.table(features_table))
    parts = []
    for name, path in (model_a, model_b):
        pred = training.test_predictions(load_model(path), split_df)
        parts.append(
            pred.select(
                F.lit(name).alias("model"), F.col(S.LABEL).cast("int").alias("label"),
                F.col("raw_prob").alias("score"), "predicted",
            )
        )
    return metrics.model_comparison(parts[0].unionByName(parts[1]), model_a[0], model_b[0])
