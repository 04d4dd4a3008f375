from collections import Counter

from helpers import COLUMNS, documents, words

from leakwatch.llm import quality_rules as Q


def base(text):
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {p for i, x in enumerate(windows) if n[x] > 1 for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    chars = sum(map(len, w))
    return len(w), chars, sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    docs, rows = documents(spark)
    got = [(r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.judge(docs).collect()]
    want = []
    for r in rows:
        b = base(r[1])
        want.append((r[0], r[1], *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_divergent_texts_go_and_plain_ones_stay(spark):
    import random

    rng = random.Random(1)
    plain = lambda: " ".join(rng.choice(["the", "of", "and", "house", "garden", "river", "to"]) for _ in range(200)) + "."
    rows = [(i, plain(), "en") for i in range(200)]
    rows += [(1000, " ".join("#$%&" for _ in range(200)), "en"), (1001, " ".join(f"{i}{i}" for i in range(200)), "en"), (1002, "QUITE LOUD " * 3 + " ".join(f"WORD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(200)), "en")]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [k for k, v in got.items() if not v] == [1000, 1001, 1002]


def test_plan_is_native(spark):
    docs, _ = documents(spark)
    plan = Q.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], COLUMNS)).collect() == []
