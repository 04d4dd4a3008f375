"""Packing: documents cut and dealt into fixed-length token windows by multiway differencing.

A task takes documents until it holds about ``block`` windows of tokens and
deals them out by Karmarkar-Karp multiway differencing: every piece starts as
a partial partition of one filled and many empty windows; the two partial
partitions with the largest imbalance are merged again and again, the fullest
windows of one with the emptiest of the other, so that imbalances cancel. The
last one left is a partition into near-equal windows. If one exceeds the
capacity, the number of windows rises and the dealing is done again.

Whole windows are cut off long documents first; what is left of a document is
cut into pieces of at most ``piece`` tokens, the finer the more equal the
windows. Blocks are independent, so packing needs no shuffle. The number of
partitions follows the bytes of text, so small inputs do not end in many
half-empty blocks.

Tokens come from a public tokenizer file. A word between spaces or line
breaks always gives the same ids, so a worker keeps the ids of the words it
has seen (at most ``CACHE_WORDS``, then it starts anew).

Defined results: a null or empty text is its end token alone; rows that share
an id are packed one by one; a null id stays null; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch.llm import cells as C
from leakwatch.llm.textcodes import chunks

CACHE_WORDS = 1_000_000
BYTES_PER_PARTITION = 24 << 20
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_TAIL = ".,;:!?"


class WordIds(dict):
    """Place of a word's token ids in ``pool``. A new word is only numbered;
    ``learn`` encodes the new ones together."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.pool, self.at, self.new = array("I"), array("q", [0]), []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _encode_letters(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of lower-case words of letters, each of which is one unit of the tokenizer."""
        out: dict[str, list[int]] = {}
        for i in range(0, len(words), 256):
            part = words[i : i + 256]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = e.ids
            at = C.runs(np.array(e.word_ids)).tolist()
            if len(at) - 1 == len(part):
                out.update((word, ids[a:b]) for word, a, b in zip(part, at[:-1], at[1:], strict=True))
            else:
                out.update(zip(part, self._encode(part), strict=True))
        return out

    def learn(self) -> None:
        parts: list[tuple[str, str] | None] = []
        for word in self.new:
            split = None
            if word and max(word) < "ɐ":  # composed Latin letters: lower case is one to one
                lower = word.lower()
                core = lower.rstrip(_TAIL)
                if core.isalpha():
                    split = (core, lower[len(core) :])
            parts.append(split)
        cores = self._encode_letters(list({p[0] for p in parts if p}))
        tails = list({p[1] for p in parts if p and p[1]})
        cores.update(zip(tails, self._encode(tails), strict=True))
        others = iter(self._encode([w for w, p in zip(self.new, parts, strict=True) if not p]))
        for p in parts:
            if p is None:
                self.pool.extend(next(others))
            else:
                self.pool.extend(cores[p[0]])
                if p[1]:
                    self.pool.extend(cores[p[1]])
            self.at.append(len(self.pool))
        self.new = []

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """Ids of each text, closed by ``end``."""
        if len(self) > CACHE_WORDS:
            self.forget()
        words = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        known = [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in words]
        del words
        self.learn()
        at = np.frombuffer(self.at, np.int64)
        pool = np.frombuffer(self.pool, np.uint32)
        out = []
        for k in known:
            first, size = at[k], at[k + 1] - at[k]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(k) else 0
            ids = np.empty(total + 1, "<u4")
            if total:
                ids[:-1] = pool[np.repeat(first - (ends - size), size) + np.arange(total)]
            ids[-1] = end
            out.append(ids)
        return out


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of each piece, by multiway differencing."""
    if k <= 1 or not len(sizes):
        return np.zeros(len(sizes), np.int64)
    heap = []
    for i, x in enumerate(sizes):
        sums = np.zeros(k, np.int64)  # from the fullest to the emptiest window
        sums[0] = x
        heap.append((-int(x), i, sums))
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []  # (a, b, order): window j was a's order[j] and b's opposite
    n = len(sizes)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        both = x + y[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        heapq.heapreplace(heap, (-int(both[0] - both[-1]), n + len(merged), both))
        merged.append((a, b, order))
    place = {n + len(merged) - 1: np.arange(k)} if merged else {0: np.arange(k)}
    out = np.zeros(n, np.int64)
    for m in range(len(merged) - 1, -1, -1):
        window, (a, b, order) = place.pop(n + m), merged[m]
        for child, slot in ((a, order), (b, k - 1 - order)):
            to = np.empty(k, np.int64)
            to[slot] = window
            if child < n:
                out[child] = to[0]
            else:
                place[child] = to
    if not merged:
        out[0] = 0
    return out


def deal(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; no window holds more than ``capacity``."""
    k = max(1, ceil(int(sizes.sum()) / capacity))
    while True:
        window = difference(sizes, k)
        if not len(sizes) or np.bincount(window, weights=sizes).max() <= capacity:
            return window
        k += max(1, k // 128)


def cut(length: int, capacity: int, piece: int) -> list[int]:
    """Lengths of a document's pieces: whole windows, then near-equal pieces of at most ``piece``."""
    whole, rest = divmod(length, capacity)
    parts = ceil(rest / piece)
    return [capacity] * whole + [(rest + i) // parts for i in range(parts)]


def pack_block(lengths: list[int], capacity: int, piece: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, window, offset) of each piece of a block."""
    doc, start, size = [], [], []
    for d, n in enumerate(lengths):
        at = 0
        for x in cut(n, capacity, piece):
            doc.append(d)
            start.append(at)
            size.append(x)
            at += x
    doc, start, size = (np.array(x, np.int64) for x in (doc, start, size))
    part = np.flatnonzero(size < capacity)
    window = np.empty(len(size), np.int64)
    window[part] = deal(size[part], capacity)
    full = np.flatnonzero(size == capacity)
    _, window[part] = np.unique(window[part], return_inverse=True)
    window[full] = (window[part].max() + 1 if len(part) else 0) + np.arange(len(full))
    order = np.argsort(window, kind="stable")
    ends = np.cumsum(size[order])
    begin = ends - size[order]
    at = C.runs(window[order])
    offset = np.empty(len(size), np.int64)
    offset[order] = begin - np.repeat(begin[at[:-1]], np.diff(at))
    return doc, start, size, window, offset


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end: int = 2,
    block: int = 128,
    piece: int = 1024,
) -> DataFrame:
    """One row per piece: document, the document's tokens before it, length,
    ids (little-endian unsigned 32-bit), tokens of the document, sequence and
    offset in it. Sequence ids are unique, not consecutive."""
    spark = docs.sparkSession
    C.whole_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.coalesce(max(1, ceil(C.text_bytes(docs, text_col) / BYTES_PER_PARTITION)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 36
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal base, held
            lengths = [len(t) for t in tokens]
            doc, start, size, window, offset = pack_block(lengths, capacity, piece)
            total = np.concatenate(tokens)
            first = np.concatenate([[0], np.cumsum(lengths)])
            out = pa.record_batch(
                [
                    pa.array([ids[d] for d in doc], pa.int64()),
                    pa.array(start),
                    pa.array(size),
                    C.sliced(total, np.append(first[doc] + start, len(total))),
                    pa.array(np.array(lengths, np.int64)[doc]),
                    pa.array(base + window),
                    pa.array(offset),
                ],
                schema=_ARROW,
            )
            base += int(window.max()) + 1
            ids.clear()
            tokens.clear()
            held = 0
            return out

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts, 1 << 20):
                new = words.encode(texts[a:b], end)
                for key, t in zip(batch.column("id").slice(a, b - a).to_pylist(), new, strict=True):
                    ids.append(key)
                    tokens.append(t)
                    held += len(t)
                    if held >= block * capacity:
                        yield flush()
        if tokens:
            yield flush()
        C.give_back()

    return source.mapInArrow(run, PIECES)
