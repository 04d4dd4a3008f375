"""Train, evaluate and compare boosted-tree models, all on Spark."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators import metrics
from leakwatch.operators.boosting import Boosting
from leakwatch.operators.model import BoostParams, RiskModel, first_trees, fit_classifier, fit_encoder, model_inputs, predict, start_fit
from leakwatch.operators.split import stratified_split
from leakwatch.operators.target_statistics import fit_target_encoder, ordered_statistics


def split_features(features: DataFrame, validation_fraction: float = 0.0, seed: int = 42) -> DataFrame:
    """Feature table plus a reproducible stratified ``split`` column.

    Checkpointed: training reads the split many times (one pass per tree)
    and must see the same rows every time, also after a lost executor.
    Boosting runs several stages per tree over these partitions: at least one
    for each core, whatever the size.
    """
    spark = features.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return stratified_split(features, validation_fraction=validation_fraction, seed=seed).repartition(n).checkpoint(eager=True)


def train(split_df: DataFrame, params: BoostParams = BoostParams(), codes: str = "ordinal", categorical: list[str] = S.CATEGORICAL_COLS) -> RiskModel:
    """Fit on ``train`` rows only. ``codes`` of the categorical columns:
    ``ordinal``, or ``statistics`` (ordered target statistics)."""
    rows = split_df.where(F.col("split") == "train")
    return fit_classifier(rows, params, **training_codes(rows, codes, categorical))


def training_codes(rows: DataFrame, codes: str, categorical: list[str] = S.CATEGORICAL_COLS) -> dict:
    """The encoder for rows to score and the encoded training rows."""
    if codes == "ordinal":
        return {"encoder": fit_encoder(rows, categorical)}
    if codes != "statistics":
        raise ValueError(f"unknown codes {codes!r}")
    encoder = fit_target_encoder(rows, categorical)
    # Boosting reads the rows many times: the running totals are computed once.
    return {"encoder": encoder, "encoded": ordered_statistics(rows, encoder).checkpoint(eager=True)}


def train_early_stop(
    split_df: DataFrame, params: BoostParams = BoostParams(max_iter=500), patience: int = 50, first_round: int = 100,
    codes: str = "ordinal", categorical: list[str] = S.CATEGORICAL_COLS, numeric: list[str] = S.NUMERIC_COLS,
) -> tuple[RiskModel, int, DataFrame]:
    """Fit on ``train``, stop by AUC on ``validation``.

    1. ``train`` rows alone are boosted; no loss rule stops it.
    2. The validation AUC of every tree prefix comes from the counted margins
       (one row per prefix).
    3. The best prefix is the highest AUC seen before ``patience`` prefixes in
       a row fail to beat it; the model is that prefix of the same fit, with
       the same codes.

    Boosting is deterministic, so a fit of fewer trees is a prefix of a longer
    one: ``first_round`` trees are grown first, and on to twice as many as long
    as the patience has not run out, up to ``max_iter``. No tree is grown and
    no prefix measured twice.

    Returns the model, its tree count and the per-prefix AUC table.
    """
    from leakwatch.operators.explain import staged_margins

    rows, validation = (split_df.where(F.col("split") == s) for s in ("train", "validation"))
    coded = training_codes(rows, codes, categorical)
    encoder = coded["encoder"]
    learn = coded["encoded"] if "encoded" in coded else encoder.encode(rows)
    fit = start_fit(learn, model_inputs(encoder, numeric), params)
    n = min(first_round, params.max_iter)
    aucs: list[tuple[int, float | None]] = []
    while True:
        model = fit_classifier(rows, replace(params, max_iter=n), numeric=numeric, **coded, grown=fit)
        per_prefix = metrics.auc_of_counts(staged_margins(model, validation, after=len(aucs)), ["n_trees"])
        # One row per tree (bounded by max_iter): read on the driver.
        aucs += sorted((r["n_trees"], r["auc_roc"]) for r in per_prefix.collect())
        best_k, stopped = best_prefix(aucs, patience)
        if stopped or n >= params.max_iter:
            return first_trees(model, best_k), best_k, split_df.sparkSession.createDataFrame(aucs, "n_trees int, auc_roc double")
        n = min(2 * n, params.max_iter)


def train_continued(
    split_df: DataFrame, params: BoostParams = BoostParams(max_iter=500), patience: int = 50, check_every: int = 25,
    codes: str = "ordinal", categorical: list[str] = S.CATEGORICAL_COLS, numeric: list[str] = S.NUMERIC_COLS,
) -> tuple[RiskModel, int, DataFrame]:
    """``train_early_stop`` without a second fit: trees from histograms
    (``operators.boosting``), grown on ``check_every`` at a time from kept
    margins until the validation AUC has not improved for ``patience`` trees.

    At most best + ``patience`` + ``check_every`` trees are ever grown. Returns
    the model, its tree count and the AUC of every prefix.
    """
    rows, validation = (split_df.where(F.col("split") == s) for s in ("train", "validation"))
    coded = training_codes(rows, codes, categorical)
    encoder = coded["encoder"]
    inputs = model_inputs(encoder, numeric)
    learn = coded["encoded"] if "encoded" in coded else encoder.encode(rows)
    both = learn.select(*inputs, S.LABEL, F.lit(True).alias("fits")).unionByName(
        encoder.encode(validation).select(*inputs, S.LABEL, F.lit(False).alias("fits"))
    )
    fit = Boosting(both, inputs, S.LABEL, params)
    aucs: list[tuple[int, float | None]] = []
    while True:
        fit.grow(min(check_every, params.max_iter - len(fit.trees)))
        # One row per tree (bounded by max_iter): read on the driver.
        aucs += sorted((r["n_trees"], r["auc_roc"]) for r in metrics.auc_of_counts(fit.staged(), ["n_trees"]).collect())
        best_k, stopped = best_prefix(aucs, patience)
        if stopped or len(fit.trees) >= params.max_iter:
            per_prefix = split_df.sparkSession.createDataFrame(aucs, "n_trees int, auc_roc double")
            return RiskModel(encoder, list(numeric), fit.booster(best_k)), best_k, per_prefix


def best_prefix(aucs: list[tuple[int, float | None]], patience: int) -> tuple[int, bool]:
    """The prefix with the highest AUC (the first on ties), and whether
    ``patience`` prefixes in a row failed to beat it."""
    best_k, best = 1, float("-inf")
    for k, auc in aucs:
        if auc is not None and auc > best:
            best_k, best = k, auc
        elif k - best_k >= patience:
            return best_k, True
    return best_k, False


def test_predictions(model: RiskModel, split_df: DataFrame) -> DataFrame:
    """Predictions on the held-out ``test`` rows."""
    return predict(model, split_df.where(F.col("split") == "test"))


def evaluate(pred: DataFrame, label: str = S.LABEL) -> dict[str, DataFrame]:
    """Ranking and threshold metrics of a prediction table."""
    scored = pred.select(F.col(label).cast("int").alias("label"), F.col("raw_prob").alias("score"), "predicted")
    return {
        "auc_roc": metrics.auc_roc(scored),
        "average_precision": metrics.average_precision(scored),
        "confusion_matrix": metrics.confusion_matrix(scored),
        "classification_report": metrics.classification_report(scored),
        "best_f1_threshold": metrics.best_f1_threshold(scored),
    }


def tuned_threshold(model: RiskModel, split_df: DataFrame, tune_on: str = "validation") -> DataFrame:
    """Best-F1 threshold chosen on ``tune_on`` rows, with the confusion counts
    it gives on the ``test`` rows.

    Tuning on validation rows keeps the test rows unseen; ``tune_on="test"``
    reproduces the original job (tuned and reported on the same rows).
    """
    def scored(part: str) -> DataFrame:
        pred = predict(model, split_df.where(F.col("split") == part))
        return pred.select(F.col(S.LABEL).cast("int").alias("label"), F.col("raw_prob").alias("score"))

    # One row: its values are literals for the test rows.
    threshold, f1 = metrics.best_f1_threshold(scored(tune_on)).select("threshold", "f1").first() or (None, None)
    test = scored("test").withColumns({"threshold": F.lit(threshold).cast("double"), "tuned_f1": F.lit(f1).cast("double")})
    y, hit = F.col("label") == 1, F.col("score") >= F.col("threshold")

    def count_if(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    return test.groupBy("threshold", "tuned_f1").agg(
        count_if(~y & ~hit).alias("tn"), count_if(~y & hit).alias("fp"),
        count_if(y & ~hit).alias("fn"), count_if(y & hit).alias("tp"),
    )
