import random

import numpy as np
from helpers import COLUMNS, documents

from leakwatch.llm import kneser_ney as K
from leakwatch.llm import language_mixture as M


def brute_force_log_p(trusted):
    """The textbook recursion over plain dictionaries."""
    from collections import Counter

    seqs = [K.BEGIN * (K.ORDER - 1) + " ".join(t.split()) + K.END for t in trusted if t and t.split()]
    counts = {K.ORDER: Counter(s[i : i + K.ORDER] for s in seqs for i in range(len(s) - K.ORDER + 1))}
    for k in range(K.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        if not all(n[:3]):
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
        return [min(max(d, 0.1), i) for i, d in enumerate(raw, 1)]

    d = {k: discounts(c) for k, c in counts.items()}
    total, weight = {}, {}
    for k, c in counts.items():
        for g, n in c.items():
            total[k, g[:-1]] = total.get((k, g[:-1]), 0) + n
            weight[k, g[:-1]] = weight.get((k, g[:-1]), 0) + d[k][min(n, 3) - 1]
    size = len(counts[1])

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (size + 1)
        if (k, g[:-1]) not in total:
            return p(g[1:])
        n = counts[k].get(g, 0)
        own = (n - d[k][min(n, 3) - 1]) / total[k, g[:-1]] if n else 0.0
        return own + weight[k, g[:-1]] / total[k, g[:-1]] * p(g[1:])

    return p


def test_perplexity_equals_the_textbook(spark):
    docs, rows = documents(spark, n=20)
    trusted = [r[1] for r in rows[::2]]
    table = spark.createDataFrame([(t,) for t in trusted], "text string")
    model = K.learn(table)
    p = brute_force_log_p(trusted)
    for bound in (K.MAX_BROADCAST, 0):  # broadcast tables, and joins
        got = K.score(docs, model, max_broadcast=bound).collect()
        assert len(got) == len(rows)
        for r in got:
            if not (r.text and r.text.split()):
                assert r.n_symbols == 0 and r.log_loss is None
                continue
            if len(r.text) > 20_000 and bound:
                continue
            s = K.BEGIN * 4 + " ".join(r.text.split()) + K.END
            grams = [s[i : i + 5] for i in range(len(s) - 4)]
            known = {g: np.log(p(g)) for g in set(grams)}
            assert r.n_symbols == len(grams)
            assert abs(r.log_loss + np.mean([known[g] for g in grams])) < 1e-5


def test_probabilities_sum_to_one(spark):
    table = spark.createDataFrame([("banana bandana",), ("an ant ran",)], "text string")
    model = K.learn(table)
    tables = K.Tables({k: K._table(t, K.S[-k:], "lp") for k, t in model.grams.items()}, {k: K._table(t, K.S[-k:-1], "lw") for k, t in model.contexts.items()}, model.unknown)
    chars = sorted({r.e for r in model.grams[1].collect()})
    for context in ("bana", "zzzz", "an a"):
        points = np.array([[*map(ord, context), c] for c in [*chars, 0x10FFF]], np.uint32)
        lp = tables.log_p(points.ravel(), np.arange(len(points)) * 5)
        assert abs(np.exp(lp).sum() - 1) < 1e-5


def test_classifier_thresholds(spark):
    rows = [(i, "en" if i < 80 else "xx", 10, 1.0 + i / 100) for i in range(100)] + [(200, "en", 400, 3.0), (201, None, 4, 1.5), (202, "en", 0, None)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long, log_loss double")
    trusted = spark.createDataFrame([(i,) for i in range(100)] + [(None,)], "doc_id long")
    got = {r.doc_id: r for r in K.classify(scored, trusted).collect()}
    assert not got[200].kept and not got[202].kept and got[202].perplexity is None and got[201].kept
    assert all(got[i].kept for i in range(100))


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLUMNS)
    model = K.learn(none)
    assert K.score(none, model).collect() == []
    assert K.score(spark.createDataFrame([("x",)], "text string"), model).first().log_loss is not None
    assert M.predict(none, M.learn(none)).collect() == []
    assert M.predict(spark.createDataFrame([("word",)], "text string"), M.learn(none)).first().lang_pred == "und"


def syllable_texts(seed, n=240):
    rng = random.Random(seed)
    parts = {"aa": ["tha", "ing", "er", "ou", "sh"], "bb": ["eau", "ion", "que", "oi"], "cc": ["sch", "ung", "ver", "keit", "ö"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        w = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([2, 8, 60]))]
        rows.append((i, " ".join(w), lang))
    return rows, parts


def test_held_out_accuracy_and_mixtures(spark):
    rows, parts = syllable_texts(1)
    model = M.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test, _ = syllable_texts(2)
    got = M.predict(spark.createDataFrame(test, "doc_id long, text string, lang string"), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    mixed = " ".join(rows[i][1] for i in range(len(rows)) if rows[i][2] == "aa")[:600] + " " + " ".join(rows[i][1] for i in range(len(rows)) if rows[i][2] == "bb")[:300]
    (r,) = M.predict(spark.createDataFrame([(mixed,)], "text string"), model).collect()
    shares = {x.lang: x.share for x in r.langs}
    assert r.lang_pred == "aa" and set(shares) == {"aa", "bb"} and 0.55 < shares["aa"] < 0.8 and r.score == shares["aa"]


def test_shares_equal_plain_expectation_maximisation():
    rng = np.random.default_rng(4)
    like = rng.random((90, 3)).astype(np.float32)
    doc = np.repeat([0, 2, 3], [10, 50, 30])
    got = M.mixtures(like, doc, 5, penalty=2.0)
    assert not got[[1, 4]].any()
    for d in (0, 2, 3):
        x = like[doc == d].astype(float)

        def run(pi, x=x):
            for _ in range(M.ROUNDS):
                r = pi * x
                r /= r.sum(1, keepdims=True)
                pi = r.mean(0)
            return pi, np.log((pi * x).sum(1)).sum()

        pi, fit = run(np.full(3, 1 / 3))
        on = np.ones(3, bool)
        while on.sum() > 1:
            less = on.copy()
            less[np.where(on, pi, np.inf).argmin()] = False
            begin = np.where(less, np.maximum(pi, 1e-6), 0)
            new, new_fit = run(begin / begin.sum())
            if new_fit + 2.0 * np.log(len(x) + 1) / 2 < fit:
                break
            pi, fit, on = new, new_fit, less
        assert np.allclose(got[d], np.where(on, pi, 0), atol=1e-3)


def test_undetermined_texts_and_awkward_rows(spark):
    docs, rows = documents(spark)
    got = M.predict(docs, M.learn(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1


def test_threshold_is_the_quantile_and_the_length_slack_alone(spark):
    rows = [(i, "en", 1_000_000, 1.0 + i / 1000) for i in range(100)] + [(200, "en", 1_000_000, 1.2), (201, "en", 100, 1.2)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long, log_loss double")
    trusted = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    got = {r.doc_id: r for r in K.classify(scored, trusted).collect()}
    assert not got[200].kept and got[201].kept  # 1.089 + 0.002, and + 0.2
    assert abs(np.log(got[200].max_perplexity) - 1.089) < 0.005


def test_both_paths_have_the_same_precision(spark):
    docs, rows = documents(spark, n=20)
    model = K.learn(spark.createDataFrame([(r[1],) for r in rows[::2]], "text string"))
    wide, joined = (sorted((str(r.doc_id), str(r.text), str(r.source), r.log_loss or 0.0) for r in K.score(docs, model, max_broadcast=b).collect()) for b in (K.MAX_BROADCAST, 0))
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-12 for a, b in zip(wide, joined, strict=True))
