"""Classifier evaluation as distributed aggregates over (label, score) rows.

Inputs are DataFrames of scored rows: a 0/1 ``label`` column, a ``score``
column (higher = more risky) and optional group columns (e.g. ``model``).
Nothing is pulled to the driver: rows are first aggregated to one row per
distinct score (partial aggregation, so a score shared by a third of all
rows is one row), then running totals in score order come from
``running_totals`` (range-partitioned, bounded tasks).

Definitions (per group):

* curve point per distinct score ``t`` (predict ``score >= t``):
  ``tp``, ``fp`` (counts at or above ``t``), precision ``tp / (tp + fp)``,
  recall ``tp / P`` (1 when there is no positive), ``fpr = fp / N``.
* ``auc_roc``: Mann-Whitney form with ties counted half,
  ``sum(pos_t * (2 * neg_below_t + neg_t)) / (2 * P * N)``; the numerator is
  an exact integer, so the value is one division. Null with a single class.
* ``average_precision``: ``sum(pos_t / P * precision_t)`` over distinct
  scores (step-wise area, not the trapezoid). Null without positives.
* best F1 threshold: ``f1 = 2pr / (p + r + 1e-8)``; the highest f1 wins and a
  tie goes to the lowest threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakwatch.operators.cumulative import running_totals

F1_EPS = 1e-8
ROUND_DIGITS = 10


def _groups(group_cols: list[str] | None) -> list[str]:
    return list(group_cols or [])


def score_counts(scored: DataFrame, label: str = "label", score: str = "score",
                 group_cols: list[str] | None = None) -> DataFrame:
    """One row per (group, distinct score): positives and negatives there."""
    g = _groups(group_cols)
    return scored.groupBy(*g, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"),
    )


def _class_totals(counts: DataFrame, g: list[str]) -> DataFrame:
    return counts.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))


ALL = "_all_rows"


def curve(scored: DataFrame, label: str = "label", score: str = "score",
          group_cols: list[str] | None = None) -> DataFrame:
    """Curve points, one per (group, distinct score), with tp/fp/P/N."""
    g = _groups(group_cols)
    # Without groups a constant key keeps the class totals an equi-join.
    key = g or [ALL]
    if not g:
        scored = scored.withColumn(ALL, F.lit(0))
    # Materialised once: both the running totals and the class totals read it.
    counts = score_counts(scored, label, score, key).checkpoint(eager=True)
    return _curve_from_counts(counts, g, key)


def _curve_from_counts(counts: DataFrame, g: list[str], key: list[str]) -> DataFrame:
    cum = running_totals(counts, key, "score", ["pos", "neg"], descending=True, materialized=True)
    # One row per group; AQE broadcasts it at run time once its size is known.
    totals = _class_totals(counts, key)
    out = cum.join(totals, key)
    return out.select(
        *g,
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        "P",
        "N",
    )


def _precision(tp: Column, fp: Column) -> Column:
    return F.when(tp + fp > 0, tp.cast("double") / (tp + fp).cast("double")).otherwise(F.lit(0.0))


def _recall(tp: Column, p: Column) -> Column:
    return F.when(p > 0, tp.cast("double") / p.cast("double")).otherwise(F.lit(1.0))


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score",
             group_cols: list[str] | None = None) -> DataFrame:
    """Precision and recall at every distinct score used as threshold."""
    g = _groups(group_cols)
    c = curve(scored, label, score, g)
    return c.select(
        *g, "threshold", "tp", "fp",
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        _recall(F.col("tp"), F.col("P")).alias("recall"),
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score",
              group_cols: list[str] | None = None) -> DataFrame:
    """False- and true-positive rates at every distinct score (no points dropped)."""
    g = _groups(group_cols)
    c = curve(scored, label, score, g)
    return c.select(
        *g, "threshold", "tp", "fp",
        F.when(F.col("N") > 0, F.col("fp") / F.col("N")).alias("fpr"),
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("tpr"),
    )


def _auc_ap(c: DataFrame, g: list[str]) -> DataFrame:
    neg_below = F.col("N") - F.col("fp")
    term = F.col("pos").cast("decimal(38,0)") * (2 * neg_below + F.col("neg")).cast("decimal(38,0)")
    prec = _precision(F.col("tp"), F.col("fp"))
    return c.groupBy(*g).agg(
        F.sum(term).alias("_num"),
        F.max("P").alias("P"),
        F.max("N").alias("N"),
        F.sum(F.col("pos").cast("double") * prec).alias("_ap"),
    ).select(
        *g,
        F.when(
            (F.col("P") > 0) & (F.col("N") > 0),
            F.col("_num").cast("double") / (F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double")),
        ).alias("auc_roc"),
        F.when(F.col("P") > 0, F.round(F.col("_ap") / F.col("P").cast("double"), ROUND_DIGITS)).alias(
            "average_precision"
        ),
    )


def auc_roc(scored: DataFrame, label: str = "label", score: str = "score",
            group_cols: list[str] | None = None) -> DataFrame:
    g = _groups(group_cols)
    return _auc_ap(curve(scored, label, score, g), g).select(*g, "auc_roc")


def auc_of_counts(counts: DataFrame, group_cols: list[str]) -> DataFrame:
    """AUC per group of a table with one row per (group, ``score``) and its
    ``pos`` and ``neg`` counts."""
    return _auc_ap(_curve_from_counts(counts.checkpoint(eager=True), group_cols, group_cols), group_cols).select(*group_cols, "auc_roc")


def average_precision(scored: DataFrame, label: str = "label", score: str = "score",
                      group_cols: list[str] | None = None) -> DataFrame:
    g = _groups(group_cols)
    return _auc_ap(curve(scored, label, score, g), g).select(*g, "average_precision")


def score_histogram(scored: DataFrame, label: str = "label", score: str = "score", group_cols: list[str] | None = None, n_bins: int = 65_536) -> DataFrame:
    """(groups, bin, pos, neg): labels counted by score, in equal bins of [0, 1].

    The exact curves hold one row per distinct score, which for continuous
    scores is one per row; a histogram has at most ``n_bins`` rows a group.
    Histograms of parts of the data are merged by adding them up
    (``merge_histograms``). Null labels and scores are left out; scores below
    0 and above 1 are counted in the outer bins.
    """
    g = _groups(group_cols)
    at = F.least(F.greatest(F.floor(F.col(score) * n_bins), F.lit(0)), F.lit(n_bins - 1)).cast("int")
    known = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    y = F.col(label) == 1
    return known.groupBy(*g, at.alias("bin")).agg(F.sum(F.when(y, 1).otherwise(0)).alias("pos"), F.sum(F.when(y, 0).otherwise(1)).alias("neg"))


def merge_histograms(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The histogram of all rows of several ones."""
    both = first
    for other in others:
        both = both.unionByName(other)
    g = [c for c in first.columns if c not in ("pos", "neg")]
    return both.groupBy(*g).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def ranking_bounds(histogram: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Bounds between which the exact AUC-ROC and average precision lie.

    Only pairs inside a bin are in doubt. For the AUC they count as all lost
    or all won. For the average precision, a bin's positives stand one by one
    behind its negatives at worst (a sum of ``tp / (tp + fp)`` that is bounded
    by its integral) and, sharing one score, before them at best. Groups
    without positives have null bounds, and without negatives null AUC bounds.
    """
    g = _groups(group_cols)
    key = g or [ALL]
    c = histogram.withColumn(ALL, F.lit(0)).groupBy(*key, "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).checkpoint(eager=True)
    c = running_totals(c, key, "bin", ["pos", "neg"], descending=True, materialized=True).join(_class_totals(c, key), key)
    wide = lambda x: x.cast("decimal(38,0)")
    p, tp0, fp, fp0 = (x.cast("double") for x in (F.col("pos"), F.col("cum_pos") - F.col("pos"), F.col("cum_neg"), F.col("cum_neg") - F.col("neg")))
    worst = F.when(fp > 0, F.greatest(p - fp * F.log((tp0 + p + fp) / (tp0 + fp)), F.lit(0.0))).otherwise(p)
    best = F.when(p > 0, p * (tp0 + p) / (tp0 + p + fp0)).otherwise(0.0)
    sure = F.sum(wide(F.col("pos")) * wide(F.col("N") - F.col("cum_neg"))).cast("double")
    inside = F.sum(wide(F.col("pos")) * wide(F.col("neg"))).cast("double")
    pairs = F.max("P").cast("double") * F.max("N").cast("double")
    some = lambda x: F.when(F.max("P") > 0, F.round(x / F.max("P"), ROUND_DIGITS))
    return c.groupBy(*g).agg(
        F.when(pairs > 0, sure / pairs).alias("auc_low"), F.when(pairs > 0, (sure + inside) / pairs).alias("auc_high"),
        some(F.sum(worst)).alias("ap_low"), some(F.sum(best)).alias("ap_high"),
    )


def best_f1_threshold(scored: DataFrame, label: str = "label", score: str = "score",
                      group_cols: list[str] | None = None) -> DataFrame:
    """Threshold with the highest F1 (lowest threshold on ties) and the
    confusion counts when predicting ``score >= threshold``."""
    g = _groups(group_cols)
    c = curve(scored, label, score, g)
    p = _precision(F.col("tp"), F.col("fp"))
    r = _recall(F.col("tp"), F.col("P"))
    c = c.withColumns({"precision": p, "recall": r})
    c = c.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F1_EPS))
    best = c.groupBy(*g).agg(
        F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("neg_t"), "threshold", "precision", "recall",
                       "tp", "fp", "P", "N")).alias("b")
    )
    return best.select(
        *g,
        F.col("b.threshold").alias("threshold"),
        F.col("b.precision").alias("precision"),
        F.col("b.recall").alias("recall"),
        F.col("b.f1").alias("f1"),
        (F.col("b.N") - F.col("b.fp")).alias("tn"),
        F.col("b.fp").alias("fp"),
        (F.col("b.P") - F.col("b.tp")).alias("fn"),
        F.col("b.tp").alias("tp"),
    )


def confusion_matrix(pred: DataFrame, label: str = "label", predicted: str = "predicted",
                     group_cols: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp from one aggregation (per group)."""
    g = _groups(group_cols)
    y, p = F.col(label), F.col(predicted)

    def count_if(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    return pred.groupBy(*g).agg(
        count_if((y == 0) & (p == 0)).alias("tn"),
        count_if((y == 0) & (p == 1)).alias("fp"),
        count_if((y == 1) & (p == 0)).alias("fn"),
        count_if((y == 1) & (p == 1)).alias("tp"),
    )


def precision_recall(pred: DataFrame, label: str = "label", predicted: str = "predicted",
                     group_cols: list[str] | None = None) -> DataFrame:
    """Precision and recall of class 1; 0 when a denominator is 0."""
    g = _groups(group_cols)
    cm = confusion_matrix(pred, label, predicted, g)
    return cm.select(
        *g,
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0).alias(
            "recall"
        ),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, label: str = "label", predicted: str = "predicted",
                          group_cols: list[str] | None = None) -> DataFrame:
    """Per class (0, 1): precision, recall, f1, support; then accuracy,
    macro average and support-weighted average rows."""
    g = _groups(group_cols)
    cm = confusion_matrix(pred, label, predicted, g)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    s1, s0 = tp + fn, tn + fp
    stats = cm.select(
        *g,
        p0.alias("p0"), r0.alias("r0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), s1.alias("s1"),
        _ratio(tp + tn, tn + fp + fn + tp).alias("acc"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})
    total = F.col("s0") + F.col("s1")

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))

    def wavg(a, b):
        return _ratio(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), total)

    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", F.lit(None), F.lit(None), F.col("acc"), total),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
            (F.col("f0") + F.col("f1")) / 2, total),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), total),
    )
    return stats.select(*g, F.inline(rows))


# Metric names of the comparison table.
COMPARISON_METRICS = ["AUC-ROC", "AUC-PR", "Precision (class 1)", "Recall (class 1)", "False Positives",
                      "False Negatives"]


def model_summary(scored: DataFrame, model: str = "model", label: str = "label", score: str = "score",
                  predicted: str = "predicted") -> DataFrame:
    """Per model: auc_roc, average_precision, precision, recall, fp, fn.

    One pass over the scored rows: they are aggregated to (model, score,
    predicted) counts once; the curve and the confusion counts both read
    that small checkpointed table.
    """
    y = F.col(label) == 1
    agg = scored.groupBy(model, F.col(score).alias("score"), F.col(predicted).alias("_pred")).agg(
        F.sum(F.when(y, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(y, 0).otherwise(1)).cast("long").alias("neg"),
    ).checkpoint(eager=True)
    counts = agg.groupBy(model, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).checkpoint(
        eager=True
    )
    ranking = _auc_ap(_curve_from_counts(counts, [model], [model]), [model])
    p1 = F.col("_pred") == 1
    cm = agg.groupBy(model).agg(
        F.sum(F.when(p1, F.col("neg")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(p1, 0).otherwise(F.col("pos"))).cast("long").alias("fn"),
        F.sum(F.when(p1, F.col("pos")).otherwise(0)).cast("long").alias("tp"),
    )
    pr = cm.select(
        model,
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        "fp",
        "fn",
    )
    return ranking.join(pr, model)


def model_comparison(scored: DataFrame, model_a: str, model_b: str, model: str = "model",
                     label: str = "label", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Side-by-side metrics of two models with the winner of each row.

    Higher wins for the four ratios, lower wins for false positives and false
    negatives; every comparison is strict, so a tie goes to ``model_a``.
    """
    summary = model_summary(scored.where(F.col(model).isin(model_a, model_b)), model, label, score, predicted)
    cols = ["auc_roc", "average_precision", "precision", "recall", "fp", "fn"]
    # The summary has a row per model: one aggregate puts both side by side.
    both = summary.agg(
        *[F.max(F.when(F.col(model) == m, F.col(c))).alias(f"{side}_{c}") for side, m in (("a", model_a), ("b", model_b)) for c in cols]
    ).where(F.col("a_fp").isNotNull() & F.col("b_fp").isNotNull())
    higher_better = [True, True, True, True, False, False]
    entries = []
    for name, c, hb in zip(COMPARISON_METRICS, cols, higher_better):
        va, vb = F.col(f"a_{c}").cast("double"), F.col(f"b_{c}").cast("double")
        b_wins = (vb > va) if hb else (vb < va)
        entries.append(
            F.struct(
                F.lit(name).alias("metric"),
                va.alias("model_a"),
                vb.alias("model_b"),
                F.when(b_wins, F.lit(model_b)).otherwise(F.lit(model_a)).alias("winner"),
            )
        )
    return both.select(F.inline(F.array(*entries)))
