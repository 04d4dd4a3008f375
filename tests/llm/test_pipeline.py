"""The pipeline on the smallest table, every stage against plain Python or SQL on what its predecessor kept."""

import corpus_pipeline
import numpy as np
import pytest
from test_ngram_join import expected as expected_groups
from test_substring_dedup import expected as expected_cuts

from leakwatch.llm import language_mixture
from leakwatch.llm.queries import ORACLE, QUERIES, tokenizer

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), name)
        if name != "packing":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_quality_stage_keeps_what_the_sql_keeps(stages):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op6_quality_rules']}) WHERE kept").fetchall()}
    assert sorted(r.doc_id for r in stages[1]) == sorted(kept) and 0 < len(kept) < len(stages[0])


def test_language_stage(spark, stages):
    model = language_mixture.learn(spark.createDataFrame(stages[1]))
    found = language_mixture.identify([r.text for r in stages[1]], model, 2.0).to_pylist()
    want = {r.doc_id: f["lang_pred"] for r, f in zip(stages[1], found, strict=True) if f["lang_pred"] != "und" and f["score"] >= corpus_pipeline.MIN_SHARE}
    assert {r.doc_id: r.lang for r in stages[2]} == want
    assert np.mean([r.lang == dict((s.doc_id, s.lang) for s in stages[1])[r.doc_id] for r in stages[2]]) > 0.95


def test_one_document_of_each_group_stays(stages):
    groups = expected_groups([tuple(r) for r in stages[2]])
    assert sorted(r.doc_id for r in stages[3]) == sorted(g[0] for g in groups if g[0] == g[2]) and len(stages[3]) < len(stages[2])


def test_repeated_passages_go(stages):
    import hashlib

    want = {w[0]: w for w in expected_cuts([tuple(r) for r in stages[3]], 13)}
    assert {r.doc_id for r in stages[4]} == set(want)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][3] and r.n_chars == len(r.text) for r in stages[4])


def test_sequences_hold_every_token(stages):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    pieces = {}
    for r in stages[5]:
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for r in stages[4]:
        got = sum((ids for _, ids in sorted(pieces.pop(r.doc_id))), [])
        assert got == reference.encode(r.text, add_special_tokens=False).ids + [2]
    assert not pieces


def test_run_returns_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length)
    assert sorted(map(key, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(key, stages[5]))


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).collect() == []


def test_queries_equal_their_sql(spark):
    import duckdb

    from tools.check_oracle import _rows

    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, FOLDER)
        res = con.execute(sql)
        columns = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(columns), name
        assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), columns), name
