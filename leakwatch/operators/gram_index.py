"""Which texts contain an entry of a long dictionary, by an inverted index.

Comparing every text with every entry costs texts x entries; joining all
substrings of all entry lengths costs texts x lengths. Here every entry stands
in the index under one of its q-grams only (q characters, or the whole entry if
it is shorter): the one that the fewest texts hold. An entry that holds a gram
that no text has is left out: it cannot match.

1. every distinct text is exploded into its distinct grams and these are
   counted (partial aggregation), as far as entries have them;
2. each entry takes its rarest gram; the index has one row per gram, with its
   entries;
3. the texts' grams meet the index, and a text is kept if it really contains
   one of the entries found (``contains``).

Texts travel as numbers in steps 1 to 3, with only the grams of the index: a
Bloom filter of them (``operators.key_filter``) is applied where the grams are made.
A gram that many texts hold has its texts spread over tasks (salted join: the
index has one row per gram). A gram that more than ``MAX_ENTRIES`` entries chose,
so that its row would grow with the dictionary, is not verified entry by entry:
the texts that have it are exploded into substrings of those entries' lengths
and joined by value.

Lengths and places are in characters; texts and entries are compared as they
are (no case folding). Null texts contain nothing, empty entries are not entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakwatch.operators.key_filter import only_possible
from leakwatch.operators.skew import salted_join

GRAM = 4
#: Entries of one gram that are verified in its row.
MAX_ENTRIES = 256
HOT_GRAM_TEXTS = 1_000_000


def grams(text: Column, sizes: list[int]) -> Column:
    """Distinct grams of ``text`` of the given sizes."""
    def of_size(n: int) -> Column:
        last = F.length(text) - F.lit(n - 1)
        cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))
        return F.when(last >= 1, cut).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of_size, sizes)))


def matching(texts: DataFrame, entries: DataFrame, q: int = GRAM, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """The ids of ``texts`` (``id``, ``text``; one row each) that contain one of
    ``entries`` (``entry``, distinct, not empty).

    ``texts`` and ``entries`` are read several times: they should be written or
    checkpointed, and ``id`` must be the same each time.
    """
    # At most q sizes: entries shorter than q are their own gram.
    size = F.least(F.length("entry"), F.lit(q))
    sizes = sorted(r[0] for r in entries.select(size.alias("n")).distinct().collect())
    if not sizes:
        return texts.select("id").limit(0)
    of_entry = entries.select("entry", F.explode(F.when(F.length("entry") < q, F.array("entry")).otherwise(grams(F.col("entry"), [q]))).alias("gram"))
    of_text = texts.select("id", F.explode(grams(F.col("text"), sizes)).alias("gram"))

    wanted = of_entry.select("gram").distinct()
    counts = only_possible(of_text, "gram", wanted).groupBy("gram").agg(F.count("*").alias("n"))
    # A gram that no text has counts 0 and is therefore an entry's rarest.
    rarest = of_entry.join(counts, "gram", "left").groupBy("entry").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("at"))
    chosen = rarest.where(F.col("at.n") > 0).select("entry", F.col("at.gram").alias("gram"), F.col("at.n").alias("n")).checkpoint(eager=True)

    per_gram = chosen.groupBy("gram").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    index = chosen.join(per_gram.where(F.col("k") <= max_entries).select("gram"), "gram", "left_semi")
    index = index.groupBy("gram").agg(F.collect_list("entry").alias("entries"))  # at most max_entries of them
    hot = per_gram.where(F.col("n") > HOT_GRAM_TEXTS).select("gram")
    met = salted_join(only_possible(of_text, "gram", index), index, ["gram"], hot, "inner").select("id", "entries")
    found = met.join(texts, "id").where(F.exists("entries", lambda e: F.contains("text", e))).select("id")

    crowded = per_gram.where(F.col("k") > max_entries).select("gram")
    if not crowded.isEmpty():
        rest = chosen.join(crowded, "gram", "left_semi").select(F.col("entry").alias("value"))
        having = salted_join(only_possible(of_text, "gram", crowded), crowded, ["gram"], hot, "left_semi").select("id").distinct()
        found = found.unionByName(_by_value(texts.join(having, "id", "left_semi"), rest))
    return found.distinct()


def _by_value(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """Ids of the texts that have a substring equal to one of ``value``."""
    # At most as many lengths as the longest entry has characters.
    lengths = sorted(r[0] for r in entries.select(F.length("value")).distinct().collect())
    at = texts.select("id", "text", F.explode(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)))).alias("i"))
    left = F.length("text") - F.col("i") + 1
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= left)
    subs = at.select("id", F.explode(F.transform(fits, lambda n: F.substr("text", F.col("i"), n))).alias("value"))
    return subs.join(entries, "value", "left_semi").select("id")
