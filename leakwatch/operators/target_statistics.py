"""Ordered target statistics: categorical values as numbers that boosted trees
can split, for columns with any number of values.

An ordinal code says nothing about the label, and a mean of the labels of a
value says too much: it holds the row's own label. Here the training rows
stand in a fixed random order (a seeded hash of the id), and a row's code is
the smoothed mean over the rows of its value that come before it:

    (sum of earlier labels + weight * prior) / (earlier rows + weight)

Rows to score get the statistic over all training rows of their value; a
value that training never saw gets the prior.

The order is global per value, and one value may hold a third of all rows, so
the sums are running totals over (column, value, order) ranges (see
``operators.cumulative``), not a window per value. Rows of one id share a
place in the order and do not see each other.

Defined results: a null value is the value ``"missing"``; training rows
without an id or a label get the statistic of a row to score and add nothing;
an empty training table gives the prior everywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.cumulative import ROWS_PER_RANGE, running_totals
from leakwatch.operators.model import MAX_BROADCAST_CODES, MISSING, index_suffix

PRIOR = 0.5
WEIGHT = 1.0


def order_key(key: str = S.ID, seed: int = 42) -> Column:
    """Place of a row in the order; equal for rows of one id."""
    return F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")))


def smoothed(total: Column, n: Column, prior: float = PRIOR, weight: float = WEIGHT) -> Column:
    return (F.coalesce(total, F.lit(0)) + F.lit(weight * prior)) / (F.coalesce(n, F.lit(0)) + F.lit(weight))


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(MISSING))


class TargetEncoder:
    """Statistics of the values of ``columns`` over all training rows."""

    kind = "statistic"

    def __init__(self, columns: list[str], table: DataFrame, prior: float = PRIOR):
        self.columns, self.table, self.prior = list(columns), table, prior
        self.small = table.limit(MAX_BROADCAST_CODES + 1).count() <= MAX_BROADCAST_CODES

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>_code`` for each column; unseen values get the prior."""
        out = df
        for c in self.columns:
            codes = self.table.where(F.col("column") == c).select(F.col("value").alias("_ts_v"), F.col("code").alias(index_suffix(c)))
            out = out.drop(index_suffix(c)).withColumn("_ts_k", _text(c))
            out = out.join(F.broadcast(codes) if self.small else codes, F.col("_ts_k") == F.col("_ts_v"), "left").drop("_ts_k", "_ts_v")
            out = out.withColumn(index_suffix(c), F.coalesce(index_suffix(c), F.lit(self.prior)))
        return out


def fit_target_encoder(train: DataFrame, columns: list[str] = S.CATEGORICAL_COLS, label: str = S.LABEL, key: str = S.ID,
                       prior: float = PRIOR, weight: float = WEIGHT) -> TargetEncoder:
    known = train.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in columns])
    sums = known.select(F.inline(pairs), F.col(label).cast("double").alias("y")).groupBy("column", "value").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    table = sums.select("column", "value", smoothed(F.col("s"), F.col("n"), prior, weight).alias("code")).checkpoint(eager=True)
    return TargetEncoder(columns, table, prior)


def ordered_statistics(train: DataFrame, encoder: TargetEncoder, label: str = S.LABEL, key: str = S.ID, seed: int = 42,
                       weight: float = WEIGHT, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``train`` with ``<column>_code`` from the rows before each row."""
    columns, prior = encoder.columns, encoder.prior
    known = F.col(label).isNotNull() & F.col(key).isNotNull()
    keyed = train.withColumn("_ts_o", F.when(known, order_key(key, seed)))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in columns])
    # One row per (column, value, place): copies of an id add up before they meet.
    at = keyed.where(known).select("_ts_o", F.inline(pairs), F.col(label).cast("double").alias("y"))
    at = at.groupBy("column", "value", "_ts_o").agg(F.sum("y").alias("s"), F.count("*").cast("double").alias("n"))
    run = running_totals(at, ["column", "value"], "_ts_o", ["s", "n"], descending=False, rows_per_range=rows_per_range)
    code = smoothed(F.col("cum_s") - F.col("s"), F.col("cum_n") - F.col("n"), prior, weight)
    run = run.select("column", "value", "_ts_o", code.alias("code"))
    # A place has one value of a column unless rows of an id differ in it: a map of (column, value).
    codes = run.groupBy("_ts_o").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("column", "value"), "code"))).alias("_ts_c"))
    out = encoder.encode(keyed).join(codes, "_ts_o", "left")
    own = {index_suffix(c): F.coalesce(F.try_element_at("_ts_c", F.struct(F.lit(c).alias("column"), _text(c).alias("value"))), F.col(index_suffix(c))) for c in columns}
    return out.withColumns(own).select(*reduce(lambda names, c: [n for n in names if n != index_suffix(c)], columns, train.columns), *own)
