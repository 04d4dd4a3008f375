"""Token counts through a digest cache.

A count belongs to a content and a tokenizer. The key is the SHA-256 of the
content's bytes and a version digest of all that decides the ids: the
library, its release and the bytes of the vocabulary file. Counts are kept in
a cache table, one folder per version. A run reduces the documents to their
distinct contents (partial sums first, so a content that a third of all rows
share crosses the network once per task), joins these to the stored counts,
encodes what is missing, appends it to the cache and joins the counts to the
documents. The counts of a failed append are not seen, and a content that two
writers append at once is read as one.

Contents are normalised (null: empty) and otherwise taken byte by byte: the
cache never gives a text the count of another one.

Encoding: text between two spaces always gives the same tokens when the
tokenizer cuts by the byte-level pattern, which no piece crosses from a
character that is not white space to one that is. For such tokenizers a
worker keeps the counts of the words it has seen (``CACHE_WORDS``, then it
starts anew) and encodes new ones many at a time, a line each: the token of
the line break, which no other token holds there, parts them. Other
tokenizers encode whole texts.

Defined results: one row per row of ``docs``; a null text counts as empty,
with 0 bytes and 0 tokens; rows that share an id or a text are counted one by
one; a null id stays null; an empty table gives an empty result; other
columns, whatever their names, are not read. Very long texts are encoded
whole, in one task each.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch.llm.tables import arrow_batches

CACHE_WORDS = 500_000
#: New words or whole texts that go to the tokenizer in one call.
BLOCK = 512
_COUNTS = "content binary, n_tokens long"
#: A space after white space: such a text is cut by pattern.
_RUN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
#: A word without white space.
_WORD = re.compile(r"\S+")


def version_digest(path: str) -> str:
    """Hex digest of the library, its release and the vocabulary file."""
    out = hashlib.sha256()
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    out.update(f"{library.__name__} {library.__version__}\0".encode())
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            out.update(block)
    return out.hexdigest()


class TokenCounter:
    """Token counts of texts, as the file's library gives them."""

    def __init__(self, path: str):
        self.words: dict[str, int] = {}
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            pieces = SentencePieceProcessor(model_file=path)
            self._lengths = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
            self.by_word = False
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._lengths = lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self._ids = lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        plain = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or " " in x["content"]) for x in added)
        self.special = re.compile("|".join(re.escape(x["content"]) for x in added) or "(?!)")
        line = self._ids("\n")
        self.line = line[0] if line else -1
        self.by_word = len(line) == 1 and spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True) and plain

    def _learn(self, words: list[str]) -> None:
        """Counts of words with a space before them."""
        lines, odd = [], []
        for w in words:
            (lines if _WORD.fullmatch(w) and not self.special.search(w) else odd).append(w)
        for i in range(0, len(lines), BLOCK):
            part = lines[i : i + BLOCK]
            ids = np.array([*self._ids(" " + "\n ".join(part)), self.line])
            self.words.update(zip(part, (np.diff(np.flatnonzero(ids == self.line), prepend=-1) - 1).tolist(), strict=True))
        for i in range(0, len(odd), BLOCK):
            part = odd[i : i + BLOCK]
            self.words.update(zip(part, self._lengths([f" {w}" for w in part]), strict=True))

    def _cut(self, text: str) -> list[str]:
        """The text's words; all but the first stood behind a space."""
        if not _RUN.search(text):
            return text.split(" ")
        first, *rest = _CUT.split(text)
        return [first, *(w[1:] for w in rest)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return [n for i in range(0, len(texts), BLOCK) for n in self._lengths(texts[i : i + BLOCK])]
        cut = [self._cut(t) for t in texts]
        starts = self._lengths([words.pop(0) for words in cut])
        new = set().union(*cut).difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = set().union(*cut)
        self._learn([*new])
        known = self.words.__getitem__
        return [n + sum(map(known, words)) for n, words in zip(starts, cut, strict=True)]


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


class DigestCache:
    """Stored counts: a Parquet folder that all executors share, one subfolder per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], f"{_COUNTS}, version string").write.mode("append").partitionBy("version").parquet(path)

    def read(self, version: str) -> DataFrame:
        """(content, n_tokens) of a version, one row per content."""
        stored = self.spark.read.schema(f"{_COUNTS}, version string").parquet(self.path).where(F.col("version") == version)
        return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        counts.select("content", "n_tokens", F.lit(version).alias("version")).write.mode("append").partitionBy("version").parquet(self.path)


def count_tokens(docs: DataFrame, cache: DigestCache, path: str, id_col: str = "doc_id", text_col: str = "text", version: str | None = None) -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every row of ``docs``; what the cache
    does not hold yet is encoded and appended to it. ``path`` is a vocabulary
    file at the same place on every executor."""
    spark = docs.sparkSession
    version = version or version_digest(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    content = F.unhex(F.sha2(F.col("text"), 256)).alias("content")
    rows = source.select("id", content, F.octet_length("text").cast("long").alias("n_bytes"))
    known = cache.read(version)
    distinct = source.select(content, "text").groupBy("content").agg(F.first("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(path)
        for batch in batches:
            counts = of.count(batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    with arrow_batches(spark, rows=256, size=4 << 20):
        fresh = distinct.join(known, "content", "left_anti").mapInArrow(encode, _COUNTS).checkpoint()
    cache.append(fresh, version)
    counts = fresh.union(known)
    return rows.join(counts, "content").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
