"""Bloom filters of a batch's keys and the inverted index of dictionary entries."""

import random

from pyspark.sql import functions as F

from leakwatch.operators import gram_index, increment, key_filter


def test_the_filter_holds_every_key_and_few_others(spark):
    batch = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    rows = spark.range(0, 200_000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    kept = {r.k for r in key_filter.only_possible(rows, "k", batch).collect()}
    assert set(range(0, 3000, 3)) <= kept and None not in kept
    assert len(kept) - 1000 < 200_000 * 0.01


def test_filter_edge_cases(spark):
    rows = spark.range(0, 100).select(F.col("id").alias("k"))
    assert key_filter.only_possible(rows, "k", rows.limit(0)).count() == 0
    assert key_filter.only_possible(rows, "k", spark.createDataFrame([(None,)], "k long")).count() == 0
    # Beyond the bound, and for keys of another type: no filter.
    assert key_filter.only_possible(rows, "k", rows, n_keys=key_filter.MAX_KEYS + 1).count() == 100
    assert key_filter.only_possible(rows, "k", spark.createDataFrame([(1,)], "k int")).count() == 100
    text = spark.createDataFrame([("a",), ("b",), ("",), (None,)], "k string")
    assert sorted(r.k for r in key_filter.only_possible(text, "k", text).collect()) == ["", "a", "b"]
    assert key_filter.size_in_bits(0) == 64 and key_filter.size_in_bits(key_filter.MAX_KEYS) == 1 << 26


def test_only_the_batchs_keys_of_the_history_reach_the_join(spark, tmp_path):
    path = str(tmp_path / "history")
    spark.range(0, 50_000).select(F.col("id").alias("Action_ID")).write.parquet(path)
    history = spark.read.parquet(path)
    batch = spark.range(0, 60_000, 100).select(F.col("id").alias("Action_ID")).unionByName(spark.range(0, 60_000, 100).select(F.col("id").alias("Action_ID")))
    plain = increment.new_rows(batch, history)
    filtered = increment.new_rows(batch, history, prune_to_batch_range=True)
    assert sorted(plain.collect()) == sorted(filtered.collect()) and filtered.count() == 100
    read = key_filter.only_possible(history, "Action_ID", batch)
    assert 500 <= read.count() < 1000  # of 50,000; 500 of them are the batch's
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "might" not in plan and "xxhash64" in plan and "Python" not in plan


def _brute(texts, entries):
    return sorted(i for i, t in texts if t is not None and any(e in t for e in entries))


def _found(spark, texts, entries, **kw):
    t = spark.createDataFrame(texts, "id long, text string").checkpoint()
    e = spark.createDataFrame([(x,) for x in sorted(set(entries)) if x], "entry string").checkpoint()
    return sorted(r.id for r in gram_index.matching(t, e, **kw).collect())


def test_index_equals_contains_on_random_text(spark):
    rnd = random.Random(3)
    word = lambda a, b: "".join(rnd.choice("abcä✓.") for _ in range(rnd.randint(a, b)))
    texts = [(i, word(0, 14)) for i in range(400)] + [(400, None), (401, ""), (402, "x" * 5000 + "needle" + "y" * 5000)]
    entries = [word(1, 9) for _ in range(150)] + ["needle"]
    entries = [e for e in entries if len(e) > 3] + ["✓✓"]
    want = _brute(texts, entries)
    assert 0 < len(want) < 400
    assert _found(spark, texts, entries) == want
    # Rows of the index that would hold many entries are joined by value.
    assert _found(spark, texts, entries, max_entries=1) == want
    assert _found(spark, texts, entries, max_entries=0) == want


def test_index_edge_cases(spark):
    texts = [(1, "report"), (2, None), (3, ""), (4, "rep")]
    assert _found(spark, texts, []) == []
    assert _found(spark, texts, ["r"]) == [1, 4]
    assert _found(spark, texts, ["report.pdf", "zzzz"]) == []
    assert _found(spark, texts[1:3], ["re"]) == []


def test_hot_gram_is_spread(spark, monkeypatch):
    monkeypatch.setattr(gram_index, "HOT_GRAM_TEXTS", 20)
    texts = [(i, f"client-{i}") for i in range(300)] + [(1000, "clien")]
    for limit in (256, 0):
        assert _found(spark, texts, ["client", "lient-2"], max_entries=limit) == list(range(300))


def test_a_hundred_thousand_entries(spark):
    from leakwatch.operators.dictionary_match import flag_containing_any

    kw = spark.range(100_000).selectExpr("concat('site', lpad(id * 7919 % 1000003, 7, '0'), '.example') AS value")
    rows = spark.range(20_000).selectExpr("id", "concat('cdn.site', lpad(id * 31 % 1000003, 7, '0'), CASE WHEN id % 4 = 0 THEN '.example' ELSE '.exampl' END) AS d")
    listed = {i * 7919 % 1000003 for i in range(100_000)}
    got = {r.id for r in flag_containing_any(rows, F.col("d"), kw, "hit").where("hit = 1").collect()}
    assert got == {i for i in range(20_000) if i % 4 == 0 and i * 31 % 1000003 in listed} and got


def test_domain_lists_of_any_length(spark, monkeypatch):
    from dataclasses import replace

    from leakwatch.operators import features
    from leakwatch.sources.fixture import fixture_rules

    domains = ["a.quickshare.example", "notquickshare.example", "QuickShare.example", "quickshare.example.org", "social.example", "x", "", None, "me.x"]
    df = spark.createDataFrame(list(enumerate(domains)), "Action_ID long, Target_Domain string")
    for mode in ("substring", "suffix"):
        rules = replace(fixture_rules(), risky_domains=("quickshare.example", "social.example", "x"), domain_match=mode)
        by_pattern = sorted(features.add_risky_domain(df, rules).collect())
        with monkeypatch.context() as m:
            m.setattr(features, "MAX_PATTERN_ENTRIES", 1)
            assert sorted(features.add_risky_domain(df, rules).collect()) == by_pattern
        assert len({r.is_risky_target_domain for r in by_pattern}) == 2
