"""Joins that stay balanced when one key holds a large share of the rows.

``salted_join`` joins a large ``left`` side to a ``right`` side that holds at
most one row per key, given the set of keys known to be hot (typically from
a partial aggregation the caller already has). Hot keys are few by
construction (at most total rows / hot threshold), their count is checked
before they are broadcast (more than ``MAX_HOT_KEYS`` are joined), and:

* each left row of a hot key gets a salt in ``[0, salt_buckets)``;
* the right row of a hot key is repeated once per salt;
* cold keys keep salt 0 and a single right row.

The join on (keys, salt) then spreads a hot key over ``salt_buckets`` tasks.
Any salt is correct, because every salt of a hot key has a right copy, so the
salt may come from the row position. Without hot keys it is a plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 100_000
SALT_BUCKETS = 64


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    hot_keys: DataFrame,
    how: str = "left",
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """``left.join(right, keys, how)`` with hot keys spread over tasks.

    ``right`` must hold at most one row per key; ``how`` is ``left``,
    ``inner`` or ``left_semi``.
    """
    hot = hot_keys.select(*keys)
    n_hot = hot.limit(MAX_HOT_KEYS + 1).count()
    if n_hot == 0:
        return left.join(right, keys, how)
    hot = hot.withColumn("_sk_hot", F.lit(True))
    if n_hot <= MAX_HOT_KEYS:  # beyond that Spark chooses how to join them
        hot = F.broadcast(hot)
    salted_left = left.join(hot, keys, "left").withColumn(
        "_sk_salt",
        F.when(F.col("_sk_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salt_buckets))).otherwise(F.lit(0)),
    ).drop("_sk_hot")
    salts = F.when(F.col("_sk_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(hot, keys, "left").withColumn("_sk_salt", F.explode(salts)).drop("_sk_hot")
    return salted_left.join(salted_right, [*keys, "_sk_salt"], how).drop("_sk_salt")
