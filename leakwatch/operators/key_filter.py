"""Bloom filter of a batch's keys, built by aggregates and applied to a scan.

An anti-join of a small batch against a long history shuffles every key of the
history. The batch's keys as a Bloom filter are a few bytes each: the history's
rows that the filter rules out are left in the scan's stage, and only the keys
of the batch, and one row in some hundreds of the others, are shuffled.

The filter is an array of 64-bit words. A key sets ``HASHES`` bits of it, each
by its own seeded hash; the words are summed up by ``bit_or`` (partial
aggregation) and put in order as one array, a scalar subquery of the plan that
uses it. The test is plain column arithmetic in generated code.

Its size is proven first: at most ``MAX_KEYS`` keys (counted), so at most 8 MB
pass through the driver. A larger batch gets no filter, only the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key; with 4 hashes 0.24 % of other keys pass.
BITS_PER_KEY = 16
HASHES = 4
MAX_KEYS = 1 << 22
#: Not among them: floats (two zeros), text with a collation.
KEY_TYPES = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz", "string", "binary")


def _places(key: Column, bits: int) -> list[Column]:
    """The key's bits: ``bits`` is a power of two."""
    return [F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit(bits - 1)) for seed in range(HASHES)]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def size_in_bits(n_keys: int) -> int:
    """The next power of two above ``BITS_PER_KEY`` bits a key, one word at least."""
    return 1 << max(6, (BITS_PER_KEY * n_keys - 1).bit_length())


def filter_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with ``words``, the filter of the non-null ``key`` values."""
    spark = keys.sparkSession
    place = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    held = place.select(_word(F.col("place")).alias("word"), _bit(F.col("place")).alias("bit"))
    empty = spark.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = held.unionByName(empty).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    # At most 16 * MAX_KEYS / 64 words.
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """False only for keys that are surely not in the filter (null: false)."""
    tests = [F.get(words, _word(p)).bitwiseAND(_bit(p)) != 0 for p in _places(key, bits)]
    return key.isNotNull() & reduce(lambda a, b: a & b, tests)


def only_possible(rows: DataFrame, key: str, batch: DataFrame, n_keys: int | None = None) -> DataFrame:
    """Rows of ``rows`` whose ``key`` may be one of ``batch``: all that are, and
    about one in 400 of the others. ``n_keys`` is the number of the batch's rows if
    it is known; more than ``MAX_KEYS`` leave ``rows`` as it is. Null keys go.

    Values are hashed, so only keys of one type on both sides, whose equal values
    have equal bytes (``KEY_TYPES``), are filtered; others leave ``rows`` as it is.
    """
    kind = rows.schema[key].dataType.simpleString()
    keys = batch.select(key)
    if kind not in KEY_TYPES or keys.schema[key].dataType.simpleString() != kind:
        return rows.where(F.col(key).isNotNull())
    if n_keys is None:
        n_keys = keys.limit(MAX_KEYS + 1).count()
    if n_keys > MAX_KEYS:
        return rows.where(F.col(key).isNotNull())
    bits = size_in_bits(n_keys)
    words = filter_words(keys, key, bits).scalar()
    return rows.where(may_hold(words, F.col(key), bits))
