"""Language identification as mixture inference.

Every language has a distribution over character trigrams of words (lower
case, with word ends), hashed into ``BUCKETS`` buckets and smoothed, learned
from the documents whose language is known. A text is a mixture: each of its
words comes from one language, with the text's own proportions. Expectation
maximisation estimates the proportions from the words' trigram likelihoods
under all languages. Then the set of languages is chosen by penalised
likelihood: the language with the least share is dropped, the rest estimated
anew, as long as the likelihood loses less than ``penalty * log(words) / 2``
for the parameter saved.

Counting is one pass with one row per (task, language, bucket) and a sum in
Spark. The model holds ``BUCKETS`` numbers a language, whatever the size of
the corpus; the number of languages is checked before it goes to the
executors.

Defined results: ``und`` with score 0 for a null text and one without a
letter; ties go to the language first in order; an untrained model (no
labelled text) makes every text ``und``; rows are judged one by one, repeated
or not; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.llm import cells as C
from leakwatch.llm.textcodes import chunks

BUCKETS = 1 << 16
MAX_LANGUAGES = 512
#: Pseudo-count of each bucket.
ALPHA = 0.5
ROUNDS = 6

_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letter:
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams in text order, where each word's trigrams
    begin, and the text of each word."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    # One mark between words: keep letters, and the first other character after a letter.
    end = np.zeros(len(points), bool)
    end[1:] = letter[:-1] & ~letter[1:]
    at = np.flatnonzero(letter | end)
    kept = np.where(letter[at], points[at], 0).astype(np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), kept[:-1]])
    two = np.concatenate([np.zeros(2, np.uint64), kept[:-2]])
    two = np.where(before == 0, np.uint64(0), two)
    with np.errstate(over="ignore"):
        h = kept * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + two * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (h >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    ends = np.flatnonzero(kept == 0) + 1
    word = np.concatenate([[0], ends[:-1]]) if len(ends) else np.empty(0, np.int64)
    sizes = np.array([len(t) + 1 for t in lowered])
    starts = np.concatenate([[1], 1 + np.cumsum(sizes)])
    doc = np.searchsorted(starts, at[word], side="right") - 1
    return bucket, word, doc


@dataclass
class Model:
    languages: list[str]
    #: log-likelihood of each bucket under each language
    loglik: np.ndarray


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram model of every non-null language of ``docs``."""
    spark = docs.sparkSession
    C.whole_batches(spark)
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).na.drop()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for a, b in chunks(texts):
                bucket, word, doc = trigrams(texts[a:b])
                if not len(word):
                    continue
                size = np.diff(np.append(word, len(bucket)))
                names = sorted(set(langs[a:b]))
                code = np.array([names.index(x) for x in langs[a:b]])
                both = np.bincount(np.repeat(code[doc], size) * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for i, name in enumerate(names):
                    part = both[i * BUCKETS : (i + 1) * BUCKETS]
                    sums[name] = sums[name] + part if name in sums else part
        for name, total in sums.items():
            on = np.flatnonzero(total)
            yield pa.record_batch([pa.array([name] * len(on), pa.string()), pa.array(on.astype(np.int32)), pa.array(total[on])], names=["lang", "bucket", "n"])

    counted = source.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).checkpoint()
    languages = [r[0] for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages.sort()
    table = counted.toArrow()  # at most BUCKETS rows a language
    sums = np.full((BUCKETS, max(1, len(languages))), ALPHA)
    index = {x: i for i, x in enumerate(languages)}
    column = np.array([index[x] for x in table["lang"].to_pylist()], np.int64)
    sums[table["bucket"].to_numpy(), column] += table["n"].to_numpy()
    return Model(languages, np.log(sums / sums.sum(0)).astype(np.float32))


def mixtures(like: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Language shares of each text, 0 for languages outside its chosen set.

    ``like`` has a row of relative likelihoods for each word, ``doc`` the
    (sorted) text of each word."""
    n_lang = like.shape[1]
    share = np.zeros((n_docs, n_lang), np.float32)
    at = C.runs(doc)
    live = doc[at[:-1]]  # texts that have words
    first, words = at[:-1], np.diff(at).astype(np.float32)

    def estimate(pi, rows_like, rows_doc, starts, count):
        total = None
        for _ in range(ROUNDS):
            r = pi[rows_doc] * rows_like
            total = r.sum(1)
            r /= total[:, None]
            pi = np.add.reduceat(r, starts, 0) / count[:, None]
        return pi, np.add.reduceat(np.log((pi[rows_doc] * rows_like).sum(1)), starts)

    index = np.repeat(np.arange(len(live)), words.astype(np.int64))
    pi, fit = estimate(np.full((len(live), n_lang), 1 / n_lang, np.float32), like, index, first, words)
    active = np.ones((len(live), n_lang), bool)
    todo = np.arange(len(live))
    while len(todo):
        todo = todo[active[todo].sum(1) > 1]
        if not len(todo):
            break
        trial = active[todo].copy()
        trial[np.arange(len(todo)), np.where(trial, pi[todo], np.inf).argmin(1)] = False
        chosen = np.zeros(len(live), bool)
        chosen[todo] = True
        rows = chosen[index]
        count = words[todo]
        sub = np.repeat(np.arange(len(todo)), count.astype(np.int64))
        starts = np.concatenate([[0], np.cumsum(count.astype(np.int64))[:-1]])
        begin = np.maximum(np.where(trial, pi[todo], 0), 1e-6 * trial).astype(np.float32)
        new, new_fit = estimate(begin / begin.sum(1, keepdims=True), like[rows], sub, starts, count)
        better = new_fit + penalty * np.log(count + 1) / 2 >= fit[todo]
        won = todo[better]
        pi[won], fit[won], active[won] = new[better], new_fit[better], trial[better]
        todo = won
    share[live] = np.where(active, pi, 0)
    return share


PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("langs", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))),
    ]
)
_LANGS = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
_PREDICTED = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("langs", _LANGS)])


def identify(texts: list[str | None], model: Model, penalty: float) -> pa.Array:
    """Language, score and language set of each text of a small batch."""
    bucket, word, doc = trigrams(texts)
    shares = np.zeros((len(texts), len(model.languages)), np.float32)
    if len(word) and model.languages:
        like = np.add.reduceat(model.loglik[bucket], word, 0)
        like = np.exp(np.maximum(like - like.max(1, keepdims=True), -80))
        shares = mixtures(like, doc, len(texts), penalty)
    rows = []
    for s in shares:
        if not s.any():
            rows.append({"lang_pred": "und", "score": 0.0, "langs": []})
            continue
        total = float(s.sum())
        order = sorted((i for i in range(len(s)) if s[i] > 0), key=lambda i: (-s[i], model.languages[i]))
        langs = [{"lang": model.languages[i], "share": min(1.0, float(s[i]) / total)} for i in order]
        rows.append({"lang_pred": langs[0]["lang"], "score": langs[0]["share"], "langs": langs})
    return pa.array(rows, _PREDICTED)


def predict(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 2.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its share) and ``langs``, the
    chosen languages with their shares, largest first."""
    C.whole_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    @F.arrow_udf(PREDICTED)
    def found(texts: pa.Array) -> pa.Array:
        raw = texts.to_pylist()
        parts = [identify(raw[a:b], shared.value, penalty) for a, b in chunks(raw, 1 << 20)]
        return pa.concat_arrays(parts) if parts else pa.array([], _PREDICTED)

    found = found.asNondeterministic()  # a filter on the result must not run it again
    kept = docs.drop(*[f.name for f in PREDICTED if f.name != text_col])
    out = kept.withColumn("q_found", found(F.col(text_col).cast("string")))
    return out.select(*kept.columns, *[F.col("q_found")[f.name].alias(f.name) for f in PREDICTED])
