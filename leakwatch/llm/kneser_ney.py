"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is over characters (runs of white space count as one space, a text
has a begin and an end mark), with n-grams of up to ``ORDER`` = 5, learned from
trusted text. Tasks count the n-grams of their documents and Spark sums them;
everything after that are joins and sums over tables of distinct n-grams:
continuation counts of the lower orders, sums per context, three discounts an
order from the counts of counts, and the interpolated probabilities, each
order joined to the next lower one. Characters are plain integer columns, so
no key is hashed.

A document's perplexity takes the probability of every character. If the
tables hold at most ``max_broadcast`` n-grams, they go to the executors and
each task looks its characters up. Beyond that the documents' distinct
n-grams are joined with the tables, shard by shard, and summed per document.
Both ways give the same figures.

A document is kept if its perplexity is at most the ``quantile`` of trusted
documents of its language that the model was not learned from (a text is less
perplexing to a model that has seen it); languages with fewer than
``min_trusted`` of those, and null, take the quantile of all of them. What a
text may exceed it by falls with the square root of its length, as the sampling
error does.

Defined results: a null text and one of white space only have 0 characters,
a null perplexity, and are not kept; without trusted text every document with
characters is kept; rows that share an id are scored one by one; an empty
table gives an empty result; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.llm import cells as C
from leakwatch.llm.textcodes import BASE, U64, chunks, mix, window_codes

ORDER = 5
S = ["a", "b", "c", "d", "e"]  # the n-gram's characters; lower orders use the last ones
BEGIN, END = "\x02", "\x03"
#: Distinct n-grams that a task holds before it writes them.
GRAMS_PER_FLUSH = 1_000_000
MAX_BROADCAST = 6_000_000
MAX_BROADCAST_LANGUAGES = 5000


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with marks, and where each text begins. A
    text without characters is its begin marks alone."""
    parts = []
    for t in texts:
        words = t.split() if t else []
        parts.append(BEGIN * (ORDER - 1) + (" ".join(words) + END if words else ""))
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def windows(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and text of every full window of ``ORDER`` characters."""
    count = np.diff(first) - ORDER + 1
    doc = np.repeat(np.arange(len(count)), count)
    return np.arange(len(doc)) + (first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]))[doc], doc


def _distinct(code: np.ndarray, grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, at = code[order], C.runs(code[order])[:-1]
    return code[at], grams[order[at]], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a task's texts, written whenever ``GRAMS_PER_FLUSH`` are held."""
    held: list = []

    def rows() -> pa.RecordBatch:
        _, grams, n = _distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.record_batch([*(pa.array(grams[:, i].astype(np.int32)) for i in range(ORDER)), pa.array(n)], names=[*S, "n"])

    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in chunks(texts, 1 << 20):
            points, first = symbols(texts[a:b])
            at, _ = windows(points, first)
            code = window_codes(points.astype(U64), ORDER)[at]
            order = np.argsort(code, kind="stable")
            runs = C.runs(code[order])
            pick = at[order[runs[:-1]]]
            held.append((code[order[runs[:-1]]], points[pick[:, None] + np.arange(ORDER)], np.diff(runs)))
            if sum(len(h[0]) for h in held) > GRAMS_PER_FLUSH:
                held = [_distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                if len(held[0][0]) > GRAMS_PER_FLUSH // 2:
                    yield rows()
                    held = []
    if held:
        yield rows()
    del held
    C.give_back()


@dataclass
class Model:
    """Tables by order: ``grams[k]`` (characters, log p) and ``contexts[k]``
    (the k - 1 characters before, log of the weight of the lower order)."""

    grams: dict[int, DataFrame]
    contexts: dict[int, DataFrame]
    #: log probability of a character that the trusted text does not have
    unknown: float
    n_grams: int


def _discounts(counts: DataFrame) -> list[float]:
    n1, n2, n3, n4 = counts.agg(*[F.count_if(F.col("n") == i) for i in (1, 2, 3, 4)]).first()
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]


def learn(trusted: DataFrame, text_col: str = "text") -> Model:
    """Kneser-Ney tables of all of ``trusted``."""
    C.whole_batches(trusted.sparkSession)
    source = trusted.select(F.col(text_col).cast("string").alias("text")).na.drop()
    schema = ", ".join(f"{c} int" for c in S) + ", n long"
    counts = {ORDER: source.mapInArrow(_count, schema).groupBy(*S).agg(F.sum("n").alias("n")).checkpoint()}
    for k in range(ORDER - 1, 0, -1):  # in how many characters' company an n-gram was seen
        counts[k] = counts[k + 1].groupBy(*S[-k:]).agg(F.count("*").alias("n")).checkpoint()
    size, total = counts[1].agg(F.count("*"), F.sum("n")).first()
    grams, contexts, unknown, lower = {}, {}, 0.0, None
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        own, before = S[-k:], S[-k:-1]
        if k == 1:
            weight = counts[1].agg(F.sum(cut)).first()[0] / total if size else 1.0
            unknown = log(weight / (size + 1))
            p = counts[1].select(*own, ((F.col("n") - cut) / (total or 1) + weight / (size + 1)).alias("p"))
        else:
            sums = counts[k].groupBy(*before).agg(F.sum("n").alias("total"), F.sum(cut).alias("cut")).select(*before, "total", (F.col("cut") / F.col("total")).alias("w")).checkpoint()
            joined = counts[k].join(sums, before).join(lower, S[-(k - 1) :])
            p = joined.select(*own, ((F.col("n") - cut) / F.col("total") + F.col("w") * F.col("q")).alias("p"))
            contexts[k] = sums.select(*before, F.log("w").alias("lw"))
        p = p.checkpoint()
        lower = p.withColumnRenamed("p", "q")
        grams[k] = p.select(*own, F.log("p").alias("lp"))
    return Model(grams, contexts, unknown, sum(t.count() for t in [*grams.values(), *contexts.values()]))


class Lookup:
    """Values by 64-bit code, in an open table of numpy arrays."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        size = 1 << max(4, int(2 * len(code)).bit_length())
        self.mask = U64(size - 1)
        self.code, self.value, self.full = np.zeros(size, U64), np.zeros(size), np.zeros(size, bool)
        todo, slot = np.arange(len(code)), code & self.mask
        while len(todo):
            free = ~self.full[slot[todo]]
            _, one = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][one]
            at = slot[put]
            self.code[at], self.value[at], self.full[at] = code[put], value[put], True
            todo = np.setdiff1d(todo, put, assume_unique=True)
            taken = todo[self.full[slot[todo]]]
            slot[taken] = (slot[taken] + U64(1)) & self.mask

    def get(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each code (0 if it has none), and whether it has one."""
        slot = code & self.mask
        value, found = self.value[slot], self.full[slot] & (self.code[slot] == code)
        value = np.where(found, value, 0.0)
        todo = np.flatnonzero(self.full[slot] & ~found)
        while len(todo):
            slot[todo] = (slot[todo] + U64(1)) & self.mask
            hit = self.full[slot[todo]] & (self.code[slot[todo]] == code[todo])
            found[todo[hit]], value[todo[hit]] = True, self.value[slot[todo[hit]]]
            todo = todo[self.full[slot[todo]] & ~hit]
        return value, found


def _code(grams: np.ndarray) -> np.ndarray:
    """The window code of each row of characters."""
    h = np.zeros(len(grams), U64)
    with np.errstate(over="ignore"):
        for i in range(grams.shape[1]):
            h = h * U64(BASE) + grams[:, i].astype(U64)
        return mix(h)


def _table(df: DataFrame, columns: list[str], value: str) -> Lookup:
    t = df.toArrow()  # the caller has checked the size
    grams = np.stack([t[c].to_numpy() for c in columns], 1) if columns else np.zeros((len(t), 0), np.int64)
    return Lookup(_code(grams), t[value].to_numpy())


@dataclass
class Tables:
    grams: dict[int, Lookup]
    contexts: dict[int, Lookup]
    unknown: float

    def log_p(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each window."""
        value, found = self.grams[ORDER].get(window_codes(points.astype(U64), ORDER)[at])
        out, todo = value, np.flatnonzero(~found)
        seen = points[at[todo][:, None] + np.arange(ORDER)]
        for k in range(ORDER, 1, -1):
            if not len(todo):
                return out
            weight, _ = self.contexts[k].get(_code(seen[:, ORDER - k : ORDER - 1]))
            out[todo] += weight  # 0 for an unseen context: nothing is discounted there
            value, found = self.grams[k - 1].get(_code(seen[:, ORDER - k + 1 :]))
            out[todo[found]] += value[found]
            todo, seen = todo[~found], seen[~found]
        out[todo] += self.unknown
        return out


ADDED = T.StructType([T.StructField("n_symbols", T.LongType()), T.StructField("log_loss", T.DoubleType())])
_ADDED = pa.struct([("n_symbols", pa.int64()), ("log_loss", pa.float64())])


def score(docs: DataFrame, model: Model, text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with ``n_symbols`` (predicted characters) and ``log_loss``
    (mean negative log probability: the log of the perplexity)."""
    spark = docs.sparkSession
    C.whole_batches(spark)
    docs = docs.drop(*[f.name for f in ADDED if f.name != text_col])
    if model.n_grams > max_broadcast:
        return _score_by_joins(docs, model, text_col)
    tables = Tables(
        {k: _table(t, S[-k:], "lp") for k, t in model.grams.items()},
        {k: _table(t, S[-k:-1], "lw") for k, t in model.contexts.items()},
        model.unknown,
    )
    shared = spark.sparkContext.broadcast(tables)

    @F.arrow_udf(ADDED)
    def loss(texts: pa.Array) -> pa.Array:
        raw, count, mean = texts.to_pylist(), [], []
        for a, b in chunks(raw, 1 << 20):
            points, first = symbols(raw[a:b])
            at, doc = windows(points, first)
            n = np.bincount(doc, minlength=b - a)
            total = np.bincount(doc, weights=shared.value.log_p(points, at), minlength=b - a)
            count.append(n)
            mean.append(np.where(n > 0, -total / np.maximum(n, 1), np.nan))
        n, mean = (np.concatenate(x) if x else np.empty(0) for x in (count, mean))
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(mean, mask=n == 0)], fields=list(_ADDED))

    loss = loss.asNondeterministic()  # a filter on the result must not run it again
    out = docs.withColumn("k_loss", loss(F.col(text_col).cast("string")))
    return out.select(*docs.columns, *[F.col("k_loss")[f.name].alias(f.name) for f in ADDED])


def _score_by_joins(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """The same by joins of the documents' distinct n-grams with the tables."""
    rows = docs.withColumn("k_row", F.monotonically_increasing_id()).checkpoint()

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("k_row").to_numpy(), batch.column("text").to_pylist()
            for a, b in chunks(texts, 1 << 18):
                points, first = symbols(texts[a:b])
                at, doc = windows(points, first)
                code = window_codes(points.astype(U64), ORDER)[at]
                order = np.lexsort((code, doc))
                new = np.ones(len(at), bool)
                new[1:] = (code[order][1:] != code[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                one = np.flatnonzero(new)
                n = np.diff(np.append(one, len(at)))
                grams = points[at[order[one]][:, None] + np.arange(ORDER)]
                yield pa.record_batch(
                    [pa.array(ids[a:b][doc[order[one]]]), *(pa.array(grams[:, i].astype(np.int32)) for i in range(ORDER)), pa.array(n)], names=["k_row", *S, "n"]
                )

    schema = "k_row long, " + ", ".join(f"{c} int" for c in S) + ", n long"
    df = rows.select("k_row", F.col(text_col).cast("string").alias("text")).mapInArrow(distinct, schema)
    lp = F.lit(model.unknown)
    for k in range(1, ORDER + 1):
        df = df.join(model.grams[k].withColumnRenamed("lp", "g"), S[-k:], "left")
        if k > 1:
            df = df.join(model.contexts[k], S[-k:-1], "left")
            lp = F.coalesce("g", F.coalesce("lw", F.lit(0.0)) + F.col("lp"))
        else:
            lp = F.coalesce(F.col("g"), lp)
        df = df.withColumn("lp", lp).drop("g", "lw")
    sums = df.groupBy("k_row").agg(F.sum("n").alias("n_symbols"), (-F.sum(F.col("lp") * F.col("n")) / F.sum("n")).alias("log_loss"))
    out = rows.join(sums, "k_row", "left").withColumn("n_symbols", F.coalesce("n_symbols", F.lit(0).cast("long")))
    return out.select(*docs.columns, *[f.name for f in ADDED])


def classify(
    scored: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    quantile: float = 0.9,
    min_trusted: int = 50,
    slack: float = 2.0,
) -> DataFrame:
    """``scored`` with ``perplexity``, ``max_perplexity`` and ``kept``;
    ``trusted`` holds the ids of trusted documents outside the learned ones."""
    known = scored.where(F.col("log_loss").isNotNull()).join(trusted.select(id_col).distinct(), id_col, "left_semi")
    at = F.percentile_approx("log_loss", quantile, 10_000)
    per_lang = known.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("k_lang")).agg(at.alias("k_max"), F.count("*").alias("n"))
    per_lang = per_lang.where(F.col("n") >= min_trusted).drop("n").checkpoint()
    whole = known.agg(at).first()[0]
    small = per_lang.limit(MAX_BROADCAST_LANGUAGES + 1).count() <= MAX_BROADCAST_LANGUAGES
    out = scored.join(F.broadcast(per_lang) if small else per_lang, F.col(lang_col) == F.col("k_lang"), "left")
    limit = F.coalesce(F.col("k_max"), F.lit(float("inf") if whole is None else whole)) + slack / F.sqrt(F.greatest(F.col("n_symbols"), F.lit(1)))
    kept = [c for c in scored.columns if c not in ("perplexity", "max_perplexity", "kept")]
    return out.select(*kept, F.exp("log_loss").alias("perplexity"), F.exp(limit).alias("max_perplexity"), F.coalesce(F.col("log_loss") <= limit, F.lit(False)).alias("kept"))
