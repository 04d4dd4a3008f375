"""Incremental ingest and scoring helpers: key anti-joins, id assignment,
idempotent appends.

All set logic is by key with ``left_anti`` joins. Spark plans them as
sort-merge joins on unsized inputs; AQE turns them into broadcast joins at run
time when one side turns out small, and splits skewed partitions otherwise,
so no side is broadcast on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.key_filter import only_possible
from leakwatch.sources.catalog import append_table, table_exists
from leakwatch.sources.dated import append_dated, since

MAX_BROADCAST_PARTITIONS = 1_000_000


def new_rows(batch: DataFrame, existing_keys: DataFrame | None, key: str = S.ID,
             prune_to_batch_range: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing_keys``, one per key.

    A null key on the right never removes a row (anti-join semantics); a key
    repeated inside the batch is kept once: the row that is smallest in the
    order of its other columns, so every run keeps the same one. Rows without
    a key match nothing and are all kept. ``existing_keys=None`` (first run: no
    target yet) keeps the whole batch.

    ``prune_to_batch_range=True`` (for a small batch against a large history):
    only keys between the batch's min and max can match, so those bounds are
    read first (one single-row aggregate) and applied as literal filters,
    which reach the target's Parquet scan and skip row groups by statistics
    instead of reading every key ever written. A Bloom filter of the batch's
    keys (``operators.key_filter``, up to its bound of counted keys) then drops in
    the scan's stage what cannot match, so the join's shuffle follows the
    batch, not the history.
    """
    # De-duplicate first: partial aggregation collapses copies of a key on
    # the map side, so a key repeated in a large share of rows never reaches
    # the join as one big group.
    keyless = batch.where(F.col(key).isNull())
    keyed = batch.where(F.col(key).isNotNull())
    others = [c for c in batch.columns if c != key]
    if others:
        first = keyed.groupBy(key).agg(F.min(F.struct(*others)).alias("_nr_row"))
        out = first.select(*[F.col(key) if c == key else F.col("_nr_row")[c].alias(c) for c in batch.columns])
    else:
        out = keyed.distinct()
    if existing_keys is not None:
        right = existing_keys.select(key).where(F.col(key).isNotNull())
        if prune_to_batch_range:
            lo, hi, n_keys = batch.agg(F.min(key), F.max(key), F.count(key)).first()
            if lo is None:
                return keyless
            right = right.where(F.col(key).between(F.lit(lo), F.lit(hi)))
            right = only_possible(right, key, batch, n_keys)
        out = out.join(right.distinct(), on=key, how="left_anti").select(*batch.columns)
    return out.unionByName(keyless)


def unscored_since(features: DataFrame, spark: SparkSession, predictions_table: str, cutoff,
                   key: str = S.ID, ts: str = S.TS) -> DataFrame:
    """Features at or after ``cutoff`` not yet in the predictions table.

    A prediction row carries its event's timestamp, so only predictions at or
    after the cutoff can match: the predictions side is filtered by the same
    (literal, pushable) bound instead of reading every id ever scored. Of
    dated tables (``sources.dated``) only the days from the cutoff on are read.
    """
    recent = since(features, cutoff, ts)
    if not table_exists(spark, predictions_table):
        return recent
    scored = since(spark.table(predictions_table), cutoff, ts).select(key).distinct()
    return recent.join(scored, on=key, how="left_anti")


def assign_ids(batch: DataFrame, existing: DataFrame | None, key: str = S.ID) -> DataFrame:
    """Give every batch row a consecutive id after ``max(existing id)``.

    Distributed: each row gets its position inside its partition; a table of
    per-partition counts (one row per partition, so its size is bounded by the
    partition count) gives each partition its offset. The batch is
    checkpointed first so a recomputed partition gets the same ids.
    """
    start = F.lit(1).cast("long")
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(key), F.lit(0).cast("long")) + 1).scalar()
    tagged = batch.withColumn("_ai_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumns(
        {"_ai_part": F.shiftright("_ai_mid", 33), "_ai_pos": F.col("_ai_mid").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    counts = tagged.groupBy("_ai_part").agg(F.count(F.lit(1)).alias("_ai_n"))
    w = Window.orderBy("_ai_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ai_part", F.coalesce(F.sum("_ai_n").over(w), F.lit(0)).alias("_ai_off"))
    # One row per partition of the batch.
    out = tagged.join(F.broadcast(offsets) if tagged.rdd.getNumPartitions() <= MAX_BROADCAST_PARTITIONS else offsets, "_ai_part").withColumn(
        key, (start + F.col("_ai_off") + F.col("_ai_pos")).cast("long")
    )
    return out.drop("_ai_mid", "_ai_part", "_ai_pos", "_ai_off")


def append_new(
    spark: SparkSession, batch: DataFrame, target: str, key: str = S.ID, columns: list[str] | None = None, ts: str = S.TS
) -> int:
    """Append the rows of ``batch`` not yet in ``target``; return how many.

    The plan reads the table it appends to, so the new rows are written to a
    reliable checkpoint first (lineage cut, stable under executor loss), then
    counted and appended from that copy. Running it twice appends 0 rows.
    Single writer assumed: the key check and the append are not one transaction.
    Rows with the event time ``ts`` go to a dated table.
    """
    existing = spark.table(target) if table_exists(spark, target) else None
    fresh = new_rows(batch, existing, key, prune_to_batch_range=True)
    if columns:
        fresh = fresh.select(*columns)
    fresh = fresh.checkpoint(eager=True)
    n = fresh.count()
    if n:
        (append_dated(fresh, target, ts) if ts in fresh.columns else append_table(fresh, target))
        # The write may run in another session (e.g. a stream's foreachBatch);
        # drop this session's cached file listing of the target.
        spark.catalog.refreshTable(target)
    return n
