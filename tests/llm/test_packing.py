import random
import zlib

import numpy as np
import pytest
from helpers import COLUMNS, documents, texts

from leakwatch.llm import packing
from leakwatch.llm.queries import tokenizer


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


def test_word_ids_equal_the_tokenizer(reference):
    words = packing.WordIds(tokenizer("word_bpe_49k.json"))
    cases = [*texts(), "Don't WE'RE İstanbul ΣΑΣ é é ﬁ ǅ 12 3½ 中文 ñandú's a b..!? x.,", None]
    got = words.encode(cases, 2) + words.encode(cases[:9], 2)
    for t, ids in zip(cases + cases[:9], got, strict=True):
        assert ids.tolist() == reference.encode(t or "", add_special_tokens=False).ids + [2]


def test_every_token_stands_once_and_sequences_are_gapless(spark, reference):
    docs, rows = documents(spark)
    got = packing.pack(docs, tokenizer("word_bpe_49k.json"), capacity=256, block=16, piece=64).collect()
    want = sorted(reference.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows)
    pieces, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and 0 < r.length <= 256
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in sequences.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(r.length for r in got) == sum(map(len, want))
    alone = [sorted(v) for v in pieces.values() if len({s for s, _ in v}) == len(v)]
    assert alone and all(sum((ids for _, ids in v), []) in want for v in alone)
    full = sum(r.length for r in got) / (256 * len(sequences))
    assert full > 0.9


def test_differencing_is_near_equal_and_within_capacity():
    rng = random.Random(2)
    sizes = np.array([rng.randint(1, 1000) for _ in range(700)])
    window = packing.difference(sizes, 90)
    sums = np.bincount(window, weights=sizes, minlength=90)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 0.01 * sums.mean()
    dealt = packing.deal(np.array([60, 60, 60, 20]), 100)
    assert np.bincount(dealt, weights=[60, 60, 60, 20]).max() <= 100
    assert packing.difference(np.array([5]), 3).tolist() in ([0], [1], [2])


def test_empty_table_and_crc(spark):
    path = tokenizer("word_bpe_49k.json")
    assert packing.pack(spark.createDataFrame([], COLUMNS), path).collect() == []
    (r,) = packing.pack(spark.createDataFrame([(1, None)], "doc_id long, text string"), path).collect()
    assert (r.start, r.length, r.doc_tokens, r.offset) == (0, 1, 1, 0)
    assert zlib.crc32(r.ids) == zlib.crc32((2).to_bytes(4, "little"))
