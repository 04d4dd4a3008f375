"""Stratified, reproducible train / validation / test splits as a column.

The split does not depend on row order: each row's place is the rank of
``md5("<seed>:<id>")`` (ties by id) among rows of the same label. The first
``round(test_fraction * n_label)`` ranks are ``test``; of the rest, the next
``round(validation_fraction * remaining)`` are ``validation``; the others
``train``.

A rank inside a label would be one window per label: two groups, each half
the data, in one task each. Instead the hash prefix buckets each label
(md5 is uniform, so buckets are balanced whatever the data): a per-bucket
count table gives each bucket its offset and a window inside each
(label, bucket) gives the rank within it. The prefix has a fixed width
(``prefix_hex`` hex digits, 16^5 ~ 1M buckets by default), so no count job
is needed: at 10^12 rows a bucket holds ~10^6 rows, and the per-label offset
table holds at most 16^5 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.skew import salted_join

PREFIX_HEX = 5
# An id with more rows than this is salted when its split is joined back.
HOT_ID_ROWS = 1_000_000


def split_key(id_col: str = S.ID, seed: int = 42):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_split(
    df: DataFrame,
    label: str = S.LABEL,
    id_col: str = S.ID,
    test_fraction: float = 0.2,
    validation_fraction: float = 0.0,
    seed: int = 42,
    out_col: str = "split",
    prefix_hex: int = PREFIX_HEX,
    hot_rows: int = HOT_ID_ROWS,
) -> DataFrame:
    """Add ``out_col`` in {train, validation, test}, or ``none`` for rows
    without a label or an id, which belong to no split but are not lost.

    Ranks are computed over distinct (label, id) pairs weighted by their row
    counts, so copies of one id never form a big group: they collapse in a
    partial aggregation, share one split (no copy of a test row is trained
    on), and are joined back with hot ids salted. With unique ids this is
    exactly the rank rule of the module docstring.
    """
    known = F.col(label).isNotNull() & F.col(id_col).isNotNull()
    whole, df = df, df.where(known)
    # Narrow (label, id, count) table, read by the hot-id check and the
    # ranking: materialised once so the input is not recomputed for each.
    ids = df.groupBy(label, id_col).agg(F.count(F.lit(1)).alias("_sp_c")).checkpoint(eager=True)
    ids = ids.withColumn("_sp_key", split_key(id_col, seed))
    ids = ids.withColumn("_sp_b", F.substring("_sp_key", 1, prefix_hex))

    per_bucket = ids.groupBy(label, "_sp_b").agg(F.sum("_sp_c").alias("_sp_n"))
    w_off = Window.partitionBy(label).orderBy("_sp_b").rowsBetween(Window.unboundedPreceding, -1)
    w_tot = Window.partitionBy(label)
    offsets = per_bucket.select(
        label,
        "_sp_b",
        F.coalesce(F.sum("_sp_n").over(w_off), F.lit(0)).alias("_sp_off"),
        F.sum("_sp_n").over(w_tot).alias("_sp_total"),
    )
    w_in = Window.partitionBy(label, "_sp_b").orderBy("_sp_key", id_col).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ids.withColumn("_sp_before", F.coalesce(F.sum("_sp_c").over(w_in), F.lit(0))).join(
        offsets, [label, "_sp_b"]
    )
    # Rank of the id's first row among the rows of its label.
    rank = F.col("_sp_off") + F.col("_sp_before") + 1
    n_test = F.round(F.lit(test_fraction) * F.col("_sp_total"))
    n_val = F.round(F.lit(validation_fraction) * (F.col("_sp_total") - n_test))
    split = (
        F.when(rank <= n_test, F.lit("test"))
        .when(rank <= n_test + n_val, F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    assigned = ranked.select(label, id_col, split.alias(out_col))
    hot = ids.where(F.col("_sp_c") > hot_rows).select(label, id_col)
    dealt = salted_join(df, assigned, [label, id_col], hot, "inner").select(*whole.columns, out_col)
    return dealt.unionByName(whole.where(~known).withColumn(out_col, F.lit("none")))
