"""Metrics: edge cases and a brute-force cross-check on random scores."""

import random

import pytest

from leakwatch.operators import metrics


def _df(spark, rows, model=None):
    if model:
        return spark.createDataFrame([(model, y, s, p) for y, s, p in rows], "model string, label int, score double, predicted int")
    return spark.createDataFrame(rows, "label int, score double, predicted int")


def test_single_class_auc_null(spark):
    df = _df(spark, [(1, 0.2, 0), (1, 0.9, 1)])
    assert metrics.auc_roc(df).first()[0] is None


def test_all_tied_auc_half(spark):
    df = _df(spark, [(1, 0.5, 1), (0, 0.5, 1), (1, 0.5, 1), (0, 0.5, 1)])
    assert metrics.auc_roc(df).first()[0] == 0.5


def test_perfect_ranking(spark):
    df = _df(spark, [(1, 0.9, 1), (1, 0.8, 1), (0, 0.3, 0), (0, 0.1, 0)])
    assert metrics.auc_roc(df).first()[0] == 1.0
    assert metrics.average_precision(df).first()[0] == 1.0


def test_f1_tie_lowest_threshold(spark):
    # Thresholds 0.9 and 0.4 both give precision 1/1... construct equal F1:
    # t=0.9: tp=1, fp=0 -> p=1, r=1/2; t=0.2: tp=2, fp=2 -> p=1/2, r=1
    df = _df(spark, [(1, 0.9, 1), (0, 0.5, 1), (0, 0.3, 0), (1, 0.2, 0)])
    best = metrics.best_f1_threshold(df).first()
    assert best["threshold"] == 0.2
    assert (best["tn"], best["fp"], best["fn"], best["tp"]) == (0, 2, 0, 2)


def test_no_predicted_positives(spark):
    df = _df(spark, [(1, 0.1, 0), (0, 0.2, 0)])
    pr = metrics.precision_recall(df).first()
    assert pr["precision"] == 0.0 and pr["recall"] == 0.0


def _brute_auc_ap(rows):
    pos = [s for y, s, _ in rows if y == 1]
    neg = [s for y, s, _ in rows if y == 0]
    auc = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        tp = sum(1 for y, s, _ in rows if y == 1 and s >= t)
        fp = sum(1 for y, s, _ in rows if y == 0 and s >= t)
        dp = sum(1 for y, s, _ in rows if y == 1 and s == t)
        ap += dp / len(pos) * tp / (tp + fp)
    return auc, ap


@pytest.mark.parametrize("seed", [3, 4])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(300):
        y = rnd.randint(0, 1)
        s = round(rnd.random() * 0.6 + 0.3 * y, 2)
        rows.append((y, s, int(s > 0.5)))
    auc, ap = _brute_auc_ap(rows)
    df = _df(spark, rows)
    assert metrics.auc_roc(df).first()[0] == pytest.approx(auc, abs=1e-12)
    assert metrics.average_precision(df).first()[0] == pytest.approx(ap, abs=1e-9)
    # A tiny range size forces many ranges through the offset table.
    from leakwatch.operators import cumulative

    old = cumulative.ROWS_PER_RANGE
    cumulative.ROWS_PER_RANGE = 7
    try:
        c = metrics.pr_curve(df).orderBy("threshold").collect()
    finally:
        cumulative.ROWS_PER_RANGE = old
    for r in c:
        tp = sum(1 for y, s, _ in rows if y == 1 and s >= r["threshold"])
        fp = sum(1 for y, s, _ in rows if y == 0 and s >= r["threshold"])
        assert (r["tp"], r["fp"]) == (tp, fp)


def test_classification_report_rows(spark):
    df = _df(spark, [(1, 0.9, 1), (0, 0.5, 1), (0, 0.3, 0), (1, 0.2, 0), (0, 0.1, 0)])
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 0.5
    assert rep["accuracy"]["f1_score"] == pytest.approx(3 / 5)
    assert rep["0"]["support"] == 3 and rep["weighted avg"]["support"] == 5


def test_model_comparison_tie_goes_to_a(spark):
    rows = [(1, 0.9, 1), (0, 0.2, 0), (1, 0.4, 0), (0, 0.6, 1)]
    df = _df(spark, rows, "a").unionByName(_df(spark, rows, "b"))
    out = metrics.model_comparison(df, "a", "b").collect()
    assert len(out) == 6 and all(r["winner"] == "a" for r in out)


def test_rule_label_confusion_matches_fixture_measurement(spark):
    """FIXTURES.md §5: rule label vs Risk_Label over all sf0.01 events."""
    from pyspark.sql import functions as F

    from leakwatch.functions.rules import rule_label
    from leakwatch.plans import fixture_queries as Q

    f = Q.rule_score(Q.features(spark, "/root/testdata/sf0.01"))
    pred = f.select(F.col("Risk_Label").cast("int").alias("label"), rule_label("risk_score").alias("predicted"))
    cm = metrics.confusion_matrix(pred).first()
    assert (cm["tn"], cm["fn"], cm["fp"], cm["tp"]) == (5051, 756, 665, 3528)


def _exact(rows):
    """AUC with ties counted half, and step-wise average precision."""
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap = sum(sum(1 for p in pos if p == t) / len(pos) * sum(p >= t for p in pos) / sum(s >= t for _, s in rows) for t in {s for _, s in rows})
    return auc, ap


def test_histogram_bounds_hold_the_exact_values(spark):
    import random

    r = random.Random(3)
    for n_bins, kind in ((4, "any"), (16, "ties"), (64, "any"), (1, "any")):
        rows = [(int(r.random() < 0.4), None) for _ in range(150)]
        rows = [(y, min(1.0, max(0.0, r.gauss(0.4 + 0.2 * y, 0.2)))) for y, _ in rows]
        if kind == "ties":
            rows = [(y, round(s, 1)) for y, s in rows]
        df = spark.createDataFrame(rows, "label int, score double")
        whole = metrics.score_histogram(df, n_bins=n_bins)
        parts = metrics.merge_histograms(*(metrics.score_histogram(df.where(c), n_bins=n_bins) for c in ("score < 0.5", "score >= 0.5")))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect())) and whole.count() <= n_bins
        b = metrics.ranking_bounds(whole).first()
        auc, ap = _exact(rows)
        assert b.auc_low - 1e-9 <= auc <= b.auc_high + 1e-9 and b.ap_low - 1e-9 <= ap <= b.ap_high + 1e-9
        if n_bins == 64:
            assert b.auc_high - b.auc_low < 0.05 and b.ap_high - b.ap_low < 0.15


def test_histogram_bounds_by_group_and_without_a_class(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.5), ("c", 0, 0.5), ("a", None, 0.5), ("a", 1, None), ("a", 1, 1.5)], "g string, label int, score double")
    got = {r.g: tuple(r)[1:] for r in metrics.ranking_bounds(metrics.score_histogram(df, group_cols=["g"], n_bins=8), ["g"]).collect()}
    assert got["a"] == (1.0, 1.0, 1.0, 1.0) and got["b"][:2] == (None, None) and got["b"][2:] == (1.0, 1.0) and got["c"] == (None,) * 4
