import random

import pytest
from helpers import COLUMNS, documents

from leakwatch.llm import token_counts
from leakwatch.llm.queries import tokenizer
from leakwatch.llm.token_counts import DigestCache, TokenCounter, count_tokens, version_digest

PATH = tokenizer("byte_bpe_50k.json")
ODD = ["a", "b's", "'ll", " ", "  ", "\n", "\t", "\r\n", "\xa0", "é", "23", "#!", "<|endoftext|>", "<|end", "\x1c", "\x1f ", "\x85", "　", "​", "中文", "\x00", "﻿", "\x0b", "😀"]


def plain(texts, path=PATH):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return [len(SentencePieceProcessor(model_file=path).encode(t)) for t in texts]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("keep", [500_000, 20])
def test_words_give_the_librarys_counts(monkeypatch, keep):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", keep)
    r = random.Random(2)
    texts = ["".join(r.choice(ODD) for _ in range(r.randrange(30))) for _ in range(4000)] + ["", " ", "x" * 3000]
    of = TokenCounter(PATH)
    assert of.by_word
    assert [n for i in range(0, len(texts), 100) for n in of.count(texts[i : i + 100])] == plain(texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_equals_the_library_row_by_row(spark, tmp_path, name):
    docs, rows = documents(spark, n=25)
    path = tokenizer(name)
    got = count_tokens(docs, DigestCache(spark, f"{tmp_path}/cache"), path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    texts = [r[1] or "" for r in rows]
    expected = [(r[0], len(t.encode()), n) for r, t, n in zip(rows, texts, plain(texts, path), strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_only_new_contents_are_encoded(spark, tmp_path, monkeypatch):
    cache = DigestCache(spark, f"{tmp_path}/cache")
    version = version_digest(PATH)
    first = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None)], "doc_id long, text string")
    count_tokens(first, cache, PATH).collect()
    assert cache.read(version).count() == 2
    # A stored count is used as it stands: a wrong one shows that nothing is encoded again.
    stored = cache.read(version).selectExpr("content", "n_tokens + 1000 AS n_tokens")
    other = DigestCache(spark, f"{tmp_path}/other")
    other.append(stored, version)
    second = spark.createDataFrame([(1, "one two"), (4, "three"), (5, "three")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(second, other, PATH).collect()}
    assert got == {1: 1000 + plain(["one two"])[0], 4: plain(["three"])[0], 5: plain(["three"])[0]}
    assert other.read(version).count() == 3
    # Another version shares nothing; a content that was appended twice is read as one.
    assert {r.doc_id: r.n_tokens for r in count_tokens(second, other, PATH, version="v2").collect()}[1] == plain(["one two"])[0]
    other.append(other.read(version).limit(1), version)
    assert other.read(version).count() == 3


def test_empty_table_and_session(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    empty = spark.createDataFrame([], COLUMNS)
    assert count_tokens(empty, DigestCache(spark, f"{tmp_path}/cache"), PATH).count() == 0
    assert spark.conf.get(key) == before
