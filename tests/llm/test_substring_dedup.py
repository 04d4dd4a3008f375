import hashlib

import numpy as np
import pytest
from helpers import COLUMNS, documents, words

from leakwatch.llm import cells, substring_dedup
from leakwatch.llm.textcodes import window_codes, word_codes


def expected(rows, window):
    first = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - window + 1):
            if r[0] is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if r[0] is not None and first[tuple(w[i : i + window])] < r[0]:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), None if r[1] is None else hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [2, 13])
def test_equals_brute_force(spark, window, monkeypatch):
    monkeypatch.setattr(cells, "CODES_PER_SHARD", 5000)
    docs, rows = documents(spark)
    got = substring_dedup.remove_repeated(docs, window=window)
    assert set(docs.columns) <= set(got.columns)
    result = [(r.doc_id, r.n_words, r.n_removed, None if r.text is None else hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()]
    assert sorted(result, key=str) == expected(rows, window)


def test_intervals_are_maximal_and_add_up(spark):
    docs, _ = documents(spark)
    for r in substring_dedup.remove_repeated(docs, window=5).collect():
        spans = [(s.start, s.stop) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed
        assert all(a[1] < b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))


def test_empty_table(spark):
    assert substring_dedup.remove_repeated(spark.createDataFrame([], COLUMNS)).collect() == []


def test_adjacent_intervals_merge():
    flag = np.zeros(40, bool)
    flag[[0, 3, 6, 20]] = True
    assert substring_dedup.intervals(flag, 3).tolist() == [[0, 9], [20, 23]]


def test_codes_are_those_of_the_words():
    a, first = word_codes([b"one two  three", b"", b"\ttwo\nthree four", b"z" * 1000 + b" one"])
    assert first.tolist() == [0, 3, 3, 6, 8]
    assert a[1] == a[3] and a[2] == a[4] and a[0] == a[7] and len(set(a.tolist())) == 5
    assert window_codes(a, 2)[1] == window_codes(a, 2)[3]
    assert word_codes([b"One"], lower=True)[0][0] == a[0] != word_codes([b"One"])[0][0]
