"""Quality rules: distribution divergence from language references.

Two histograms of a document are compared with those of its language by
Jensen-Shannon distance (square root of the divergence, base 2, so 0 to 1):
the classes of its characters, and its common words. A language's references
come from all documents of that language: the share of each character class,
and every word of at most ``common_len`` characters that makes up at least
``common_share`` of the language's words (so at most 1 / ``common_share``
words), all others together being one more bin. Short texts say little about
a distribution: a distance counts only from ``min_chars`` characters or
``min_words`` words on, and what is allowed beyond ``max_..._distance`` falls
with the square root of the length, as the sampling error does. Two base rules hold for every text: enough words, and
not too many of them in repeated windows of eight words.

DataFrame functions only. A document is judged inside its row, so nothing of
a document is shuffled; the references are small sums with partial
aggregation.

Defined results: a null or empty text has no words and fails the base rules;
a null language is a language of its own; a language without a reference
(no words at all) has distance 0; rows that share an id are judged one by
one; an empty table gives an empty result; columns that are named like the
added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Character classes in the order in which they are taken out
#: of a text; what is left is the class "other".
CLASSES = [
    ("lower", r"\p{Ll}+"),
    ("space", SPACE),
    ("upper", r"\p{Lu}+"),
    ("mark", r"[.,;:!?]+"),
    ("digit", r"\p{Nd}+"),
    ("symbol", r"[#*$%&|<>]+"),
]
BINS = [*[name for name, _ in CLASSES], "other"]
MAX_BROADCAST_LANGUAGES = 5000


@dataclass(frozen=True)
class Rules:
    min_words_base: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    common_len: int = 4
    common_share: float = 0.004
    min_chars: int = 100
    max_char_distance: float = 0.2
    char_slack: float = 2.0
    min_words: int = 20
    max_word_distance: float = 0.3
    word_slack: float = 1.0


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    """``q_text``, its words ``q_words`` and its characters by class ``q_bins``.

    The classes are taken out of the text one after the other, the most
    frequent first, so that only the first pass reads the whole text."""
    df = df.withColumn("q_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn("q_trimmed", F.trim("q_text", F.lit(" \t\n\x0b\f\r")))
    words = F.when(F.col("q_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("q_trimmed", SPACE))
    df = df.withColumns({"q_words": words, "q_left0": F.col("q_text")})
    for i, (_, pattern) in enumerate(CLASSES):
        df = df.withColumn(f"q_left{i + 1}", F.regexp_replace(f"q_left{i}", pattern, ""))
    lengths = [F.length(f"q_left{i}").cast("long") for i in range(len(CLASSES) + 1)]
    bins = F.array(*[a - b for a, b in zip(lengths[:-1], lengths[1:], strict=True)], lengths[-1])
    return df.withColumn("q_bins", bins).drop("q_trimmed", *[f"q_left{i}" for i in range(len(CLASSES) + 1)])


def _measured(docs: DataFrame, text_col: str, rules: Rules) -> DataFrame:
    """Columns ``q_*``: what the rules need of each text."""
    df = _texts(docs, text_col)
    lines = F.filter(F.split("q_text", "\n"), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")
    df = df.withColumn("q_lines", lines)
    df = df.select(
        *docs.columns,
        "q_words",
        "q_bins",
        F.transform("q_words", lambda w: F.xxhash64(w)).alias("q_w1"),
        F.size("q_words").cast("long").alias("q_n_words"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("q_n_dup_lines"),
        F.length("q_text").cast("long").alias("q_n_chars"),
    )
    # Codes of windows by doubling: 1, 2, 4, ... words. Without a repeated
    # window of half the length there is none of the whole length.
    k, half = rules.window, 1
    while half < k:
        step = min(half, k - half)
        here, shifted = F.col(f"q_w{half}"), F.slice(f"q_w{half}", step + 1, F.greatest(F.size(f"q_w{half}") - step, F.lit(0)))
        full = F.size(f"q_w{half}") - step
        joined = F.zip_with(F.slice(here, 1, F.greatest(full, F.lit(0))), shifted, lambda a, b: F.xxhash64(a, b))
        if half * 2 >= k:
            joined = F.when(F.size(F.array_distinct(here)) < F.size(here), joined)
        df = df.withColumn(f"q_w{half + step}", joined)
        half += step
    df = df.withColumn("q_windows", F.col(f"q_w{k}"))
    # Only texts with a repeated window pay for the sort.
    dealt = F.sort_array(F.transform("q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("q_sorted", F.when(F.size(F.array_distinct("q_windows")) < F.size("q_windows"), dealt))
    twin = lambda p, i: (p["h"] == F.get("q_sorted", i - 1)["h"]) | (p["h"] == F.get("q_sorted", i + 1)["h"])
    at = F.sort_array(F.transform(F.filter("q_sorted", lambda p, i: F.coalesce(twin(p, i), F.lit(False))), lambda p: p["i"]))
    df = df.withColumn("q_at", at)
    covered = F.transform("q_at", lambda x, i: F.least(F.lit(k), F.coalesce(F.get("q_at", i + 1) - x, F.lit(k))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return df.withColumn("q_n_repeat_words", total).drop("q_windows", "q_sorted", "q_at", *[c for c in df.columns if c.startswith("q_w") and c[3:].isdigit()])


def references(docs: DataFrame, text_col: str, lang_col: str, rules: Rules) -> DataFrame:
    """One row per language: ``r_bins`` (share of each character class),
    ``r_words`` (its common words) and ``r_shares`` (theirs). One pass: the
    number of words and the classes are counted like words whose names hold
    a space, so no word is taken for them."""
    df = _texts(docs.select(F.col(lang_col).cast("string").alias("r_lang"), F.col(text_col)), text_col)
    one = lambda w, c: F.struct(w.alias("w"), c.alias("c"))
    sums = F.array(one(F.lit(" n"), F.size("q_words").cast("long")), *[one(F.lit(f" {i}"), F.get("q_bins", F.lit(i))) for i in range(len(BINS))])
    short = F.transform(F.filter("q_words", lambda w: F.length(w) <= rules.common_len), lambda w: one(w, F.lit(1).cast("long")))
    counts = df.select("r_lang", F.explode(F.concat(sums, short)).alias("x")).groupBy("r_lang", F.col("x.w").alias("w")).agg(F.sum("x.c").alias("c"))
    counts = counts.checkpoint()
    n_words = counts.where("w = ' n'").select(F.col("r_lang").alias("n_lang"), F.col("c").alias("n"))
    same = F.col("r_lang").eqNullSafe(F.col("n_lang"))
    bins = counts.where("w LIKE ' %' AND w <> ' n'").groupBy("r_lang").agg(F.sort_array(F.collect_list(F.struct("w", "c"))).alias("b"), F.sum("c").alias("total"))
    bins = bins.select(F.col("r_lang").alias("b_lang"), F.when(F.col("total") > 0, F.transform("b.c", lambda c: c / F.col("total"))).alias("r_bins"))
    words = counts.where("w NOT LIKE ' %'").join(F.broadcast(n_words), same).where(F.col("c") >= rules.common_share * F.col("n"))
    words = words.groupBy("r_lang").agg(F.sort_array(F.collect_list(F.struct("w", (F.col("c") / F.col("n")).alias("q")))).alias("l"))
    return bins.join(words, F.col("b_lang").eqNullSafe(F.col("r_lang")), "left").select(
        F.col("b_lang").alias("r_lang"),
        "r_bins",
        F.coalesce(F.col("l.w"), F.array().cast("array<string>")).alias("r_words"),
        F.coalesce(F.col("l.q"), F.array().cast("array<double>")).alias("r_shares"),
    )


def _term(p: Column, q: Column) -> Column:
    """One bin's part of the divergence."""
    m = p + q
    half = lambda x: F.when(x > 0, x * F.log2(2 * x / m)).otherwise(F.lit(0.0))
    return (half(p) + half(q)) / 2


def judge(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules | None = None, refs: DataFrame | None = None
) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``char_distance``,
    ``word_distance``, ``base_failed`` and ``kept``."""
    rules = rules or Rules()
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept"]
    base = docs.drop(*[c for c in added if c not in (text_col, lang_col)])
    refs = (references(docs, text_col, lang_col, rules) if refs is None else refs).checkpoint()
    if refs.limit(MAX_BROADCAST_LANGUAGES + 1).count() <= MAX_BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    df = _measured(base, text_col, rules).join(refs, F.col(lang_col).cast("string").eqNullSafe(F.col("r_lang")), "left")

    size = F.col("q_n_chars").cast("double")
    terms = F.zip_with("q_bins", "r_bins", lambda c, q: _term(c / size, q))
    char_d = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))

    # Positions of the text's common words in the language's list, sorted:
    # the run length of each is its count.
    short = F.filter("q_words", lambda w: F.length(w) <= rules.common_len)
    hits = F.filter(F.transform(short, lambda w: F.array_position("r_words", w).cast("int")), lambda x: x > 0)
    df = df.withColumn("q_hits", F.sort_array(hits))
    df = df.withColumn("q_seen", F.array_distinct("q_hits"))
    start = lambda i: F.array_position("q_hits", F.get("q_seen", i)).cast("int")
    count = lambda i: F.coalesce(start(i + 1), F.size("q_hits") + 1) - start(i)
    df = df.withColumn("q_counts", F.transform("q_seen", lambda _, i: count(i).cast("double")))
    n = F.col("q_n_words").cast("double")
    seen_q = F.transform("q_seen", lambda x: F.get("r_shares", x - 1))
    df = df.withColumn("q_shares", seen_q)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    both = total(F.zip_with("q_counts", "q_shares", lambda c, q: _term(c / n, q)))
    unseen = (total(F.col("r_shares")) - total(F.col("q_shares"))) / 2
    rest = _term(F.greatest(F.lit(0.0), 1 - total(F.col("q_counts")) / n), F.greatest(F.lit(0.0), 1 - total(F.col("r_shares"))))
    word_d = F.sqrt(F.greatest(F.lit(0.0), both + F.greatest(F.lit(0.0), unseen) + rest))

    df = df.withColumns(
        {
            "q_char_d": F.when((size > 0) & F.col("r_bins").isNotNull(), char_d).otherwise(F.lit(0.0)),
            "q_word_d": F.when((n > 0) & (F.size("r_words") > 0), word_d).otherwise(F.lit(0.0)),
            "q_failed": (F.col("q_n_words") < rules.min_words_base)
            | (100 * F.col("q_n_repeat_words") > rules.max_repeat_percent * F.col("q_n_words")),
        }
    )
    far = ((F.col("q_n_chars") >= rules.min_chars) & (F.col("q_char_d") > rules.max_char_distance + rules.char_slack / F.sqrt(F.greatest(size, F.lit(1.0))))) | (
        (F.col("q_n_words") >= rules.min_words) & (F.col("q_word_d") > rules.max_word_distance + rules.word_slack / F.sqrt(F.greatest(n, F.lit(1.0))))
    )
    return df.select(
        *base.columns,
        F.col("q_n_words").alias("n_words"),
        (F.col("q_n_chars") - F.get("q_bins", F.lit(BINS.index("space")))).alias("word_chars"),
        F.get("q_bins", F.lit(BINS.index("symbol"))).alias("n_symbols"),
        F.col("q_n_dup_lines").alias("n_dup_lines"),
        F.col("q_n_repeat_words").alias("n_repeat_words"),
        F.col("q_char_d").alias("char_distance"),
        F.col("q_word_d").alias("word_distance"),
        F.col("q_failed").alias("base_failed"),
        (~F.col("q_failed") & ~far).alias("kept"),
    )


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    The verdict is a long expression; without the row number in the condition
    the optimizer would move the filter down and unfold it into the scan."""
    judged = judge(docs, text_col, lang_col, rules)
    on = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judged.withColumn("q_on", on).where("q_on").select(*docs.columns)
