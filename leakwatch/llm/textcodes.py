"""Word and word-window codes of whole texts, vectorised over a batch.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r`` (the
pattern ``[^\\x20\\x09-\\x0D]+``; these bytes never occur inside a multi-byte
UTF-8 character). Each word gets a 64-bit code from its bytes, eight at a
time, and each run of ``k`` words a Rabin-Karp code: a polynomial in the word
codes modulo 2**64, rolled along the text with prefix sums.
"""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Longer words take one digest each instead of a numpy pass per eight bytes.
_LONG_WORD = 256
#: Odd bases of the two window polynomials.
BASE = 0x9E3779B97F4A7C15
CHECK_BASE = 0xC2B2AE3D27D4EB4F

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def word_codes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words, and for each text the index of its first word
    (one more entry closes the last text)."""
    joined = b"\n" + b"\n".join(texts) + b"\n" + bytes(8)
    buf = np.frombuffer(joined, np.uint8)
    if lower:
        buf = _LOWER[buf]
    inside = ~_SPACE[buf]
    inside[-8:] = False
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    at = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, at)
    length = ends - starts
    code = length.astype(U64) * U64(0x9FB21C651E98DF25)
    lanes = np.ndarray((len(buf) - 7,), "<u8", buffer=np.ascontiguousarray(buf), strides=(1,))
    idx, k = np.flatnonzero(length <= _LONG_WORD), 0
    while len(idx):
        rest = length[idx] - 8 * k
        lane = lanes[starts[idx] + 8 * k]
        cut = np.minimum(rest, 8)
        lane &= (U64(0xFFFFFFFFFFFFFFFF) >> ((8 - cut) * 8).astype(U64))
        code[idx] = mix(code[idx] ^ (lane * U64(BASE))) + U64(k + 1)
        idx, k = idx[rest > 8], k + 1
    for i in np.flatnonzero(length > _LONG_WORD):
        word = buf[starts[i] : ends[i]].tobytes()
        code[i] = U64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
    return code, first


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())

        def table(b: int) -> np.ndarray:
            out = np.ones(size, U64)
            step, done = U64(b), 1
            while done < size:  # doubling: out[done:2*done] = out[:done] * b**done
                take = min(done, size - done)
                out[done : done + take] = out[:take] * step
                step, done = step * step, done * 2
            return out

        with np.errstate(over="ignore"):
            have = _powers[base] = (table(base), table(pow(base, -1, 1 << 64)))
    return have


def window_codes(words: np.ndarray, k: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp code of the ``k`` words that start at each index; the last
    ``k - 1`` indexes have none. Windows that span two texts are the caller's
    to leave out."""
    n = len(words)
    if n < k:
        return np.empty(0, U64)
    up, down = _power_tables(base, n)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(words * down[:n], dtype=U64)])
        return mix((sums[k:] - sums[:-k]) * up[k - 1 : n])


def text_windows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start indexes of the windows inside one text, and each window's text."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    shift = first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.arange(len(doc)) + shift[doc], doc


def chunks(texts: list, max_bytes: int = 1 << 20):
    """Slices of a batch of at most ``max_bytes`` (or one text)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and size + n > max_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
