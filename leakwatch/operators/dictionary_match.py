"""Substring matching of a text column against a dictionary DataFrame.

The in-plan pattern (``functions.files.keyword_flag``) suits short word
lists. For a dictionary held as a table, the plan is chosen from its proven
size (a bounded count, never a guess):

* up to ``MAX_BROADCAST_ENTRIES`` entries: the dictionary is broadcast and
  matched with a theta left-semi join (``BroadcastNestedLoopJoin LeftSemi``,
  ``instr(text, entry) > 0``), all JVM. Cost rows x entries, so only for
  short lists.
* beyond that: an inverted index of the entries by their rarest q-gram
  (``operators.gram_index``). Texts are first reduced to distinct values
  (partial aggregation); those that share an index gram are verified. Shuffle
  joins, no broadcast of unbounded data. Texts held by more than
  ``HOT_NAME_ROWS`` rows are salted when they are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakwatch.operators.gram_index import matching
from leakwatch.operators.skew import salted_join

MAX_BROADCAST_ENTRIES = 256
HOT_NAME_ROWS = 1_000_000


def rows_containing_any(
    df: DataFrame, text: Column, dictionary: DataFrame, key_cols: list[str] | None = None, value_col: str = "value",
    max_broadcast: int = MAX_BROADCAST_ENTRIES,
) -> DataFrame:
    """Rows of ``df`` whose ``text`` contains at least one dictionary entry."""
    entries = dictionary.select(F.col(value_col).alias("_dm_v")).where(F.length("_dm_v") > 0).distinct()
    with_text = df.withColumn("_dm_t", text)
    if entries.limit(max_broadcast + 1).count() <= max_broadcast:
        hit = F.instr(F.col("_dm_t"), F.col("_dm_v")) > 0
        return with_text.join(F.broadcast(entries), hit, "left_semi").drop("_dm_t")
    matched, hot = _matching_texts(with_text, entries)
    return salted_join(with_text, matched, ["_dm_t"], hot, "left_semi").drop("_dm_t")


def flag_containing_any(df: DataFrame, text: Column, dictionary: DataFrame, out_col: str, value_col: str = "value") -> DataFrame:
    """``df`` with ``out_col``: 1 if ``text`` contains an entry, else 0."""
    entries = dictionary.select(F.col(value_col).alias("_dm_v")).where(F.length("_dm_v") > 0).distinct()
    with_text = df.withColumn("_dm_t", text)
    matched, hot = _matching_texts(with_text, entries)
    flagged = salted_join(with_text, matched.withColumn("_dm_hit", F.lit(1)), ["_dm_t"], hot, "left")
    return flagged.withColumn(out_col, F.coalesce("_dm_hit", F.lit(0)).cast("int")).select(*[c for c in df.columns if c != out_col], out_col)


def _matching_texts(df: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts ``_dm_t`` that contain an entry, and the hot texts."""
    # Names repeat a lot: match distinct names only (partial aggregation
    # collapses a name held by many rows before anything is exploded).
    # Materialised once: the substring match and the hot-name check read it.
    names = (
        df.where(F.col("_dm_t").isNotNull()).groupBy("_dm_t").agg(F.count(F.lit(1)).alias("_dm_n"))
        .withColumn("_dm_id", F.monotonically_increasing_id()).checkpoint(eager=True)
    )
    entries = entries.checkpoint(eager=True)
    # The ids are stable: they are part of the checkpoint.
    ids = matching(names.select(F.col("_dm_id").alias("id"), F.col("_dm_t").alias("text")), entries.select(F.col("_dm_v").alias("entry")))
    matched = names.join(ids.select(F.col("id").alias("_dm_id")), "_dm_id", "left_semi").select("_dm_t")
    return matched, names.where(F.col("_dm_n") > HOT_NAME_ROWS).select("_dm_t")
