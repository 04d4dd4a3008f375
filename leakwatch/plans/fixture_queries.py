"""Registered queries over the fixture upload events (``events`` → upload log).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` table of that folder. Rule-based predictions (the weighted rule
score as probability) stand in for a model wherever a query needs one, so the
ranking and report queries have exact SQL twins.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.functions.context import high_risk_position_flag, parse_timestamp, risky_domain_flag
from leakwatch.functions.files import (
    base_name,
    double_extension_flag,
    file_extension,
    high_risk_extension_flag,
    keyword_flag,
)
from leakwatch.functions.rules import rule_label, rule_probability, rule_score_hundredths
from leakwatch.operators import increment, metrics, reports
from leakwatch.operators.boosting import Boosting
from leakwatch.operators.dictionary_match import rows_containing_any
from leakwatch.operators.explain import explain
from leakwatch.operators.features import add_row_features, flag_risky_domains, time_flags
from leakwatch.operators.model import BoostParams, booster, encode, feature_importance, fit_encoder, load_model, predict, save_model
from leakwatch.operators.sketches import APPROX_COL, approx_distinct_window
from leakwatch.operators.split import stratified_split
from leakwatch.operators.target_statistics import fit_target_encoder, ordered_statistics
from leakwatch.plans import daily, jobs, scoring, training
from leakwatch.plans.feature_table import build_features, feature_table
from leakwatch.sources.catalog import list_tables, table_exists
from leakwatch.sources.dated import append_dated, overwrite_dated
from leakwatch.sources.dictionaries import load_dictionary, packaged_path
from leakwatch.session import ensure_checkpoint_dir
from leakwatch.sources.fixture import fixture_rules, upload_events

RULE_MODEL = "rule_v1"
SCORED_AT = "2024-02-01 00:00:00"
LOOKUP_ID = 163
TOP_K = 100
BURST_THRESHOLD = 10


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upload_events(spark, sf_dir)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(events(spark, sf_dir), fixture_rules())


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-row rule features alone: no window, no shuffle."""
    return add_row_features(events(spark, sf_dir), fixture_rules())


def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(events(spark, sf_dir), fixture_rules())


def rule_score(df: DataFrame) -> DataFrame:
    """Add ``risk_score`` (int hundredths) from the feature columns."""
    return df.withColumn(
        "risk_score",
        rule_score_hundredths(
            "is_risky_target_domain", "file_name_has_sensitive_keyword", S.TS, "is_high_risk_position",
            "is_monday_or_friday",
        ),
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions-table shape, with the rule score as the model."""
    return predictions_from(clean_features(spark, sf_dir))


def predictions_from(ft: DataFrame) -> DataFrame:
    """Rule-score predictions of a feature table."""
    ft = rule_score(ft)
    return ft.select(
        S.ID, S.TS, S.USER, S.OBJECT, S.DOMAIN, S.POSITION, S.LABEL,
        rule_label("risk_score").alias("predicted"),
        rule_probability("risk_score").alias("predicted_prob"),
        F.lit(SCORED_AT).cast("timestamp_ntz").alias("scored_at"),
        F.lit(RULE_MODEL).alias("model_version"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, score, predicted) for the metric queries."""
    p = rule_predictions(spark, sf_dir)
    return p.select(
        F.col(S.ID).alias("id"), F.col(S.LABEL).cast("int").alias("label"),
        F.col("predicted_prob").alias("score"), "predicted",
    )


def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, id, label, score, predicted) for the rule model and a variant
    with an id-based perturbation of the score."""
    ft = rule_score(clean_features(spark, sf_dir))
    noisy = F.col("risk_score") + F.pmod(F.col(S.ID) * 17, F.lit(23)) - 11

    def one(name, hundredths):
        return ft.select(
            F.lit(name).alias("model"), F.col(S.ID).alias("id"), F.col(S.LABEL).cast("int").alias("label"),
            (hundredths.cast("double") / F.lit(100.0)).alias("score"),
            F.when(hundredths > 35, 1).otherwise(0).alias("predicted"),
        )

    return one("rule", F.col("risk_score")).unionByName(one("rule_noisy", noisy))


# --- sources / projections -------------------------------------------------

def q_scan_events(spark, d):
    return events(spark, d)


def q_feature_table(spark, d):
    return clean_features(spark, d)


def q_feature_table_bucketed(spark, d):
    """The feature table through the skew-proof time-bucketed window plan
    (the plan ``auto`` picks once any user exceeds the proven bound)."""
    return feature_table(events(spark, d), fixture_rules(), strategy="bucketed")


def q_drop_incomplete(spark, d):
    return events(spark, d).na.drop(how="any")


def q_file_parts(spark, d):
    return events(spark, d).select(
        S.ID, S.OBJECT, base_name(S.OBJECT).alias("file_name"), file_extension(S.OBJECT).alias("file_extension")
    )


def q_double_extension(spark, d):
    r = fixture_rules()
    return events(spark, d).select(
        S.ID, S.OBJECT, double_extension_flag(base_name(S.OBJECT), r.double_extensions).alias("double_extension_check")
    )


def q_high_risk_extension(spark, d):
    r = fixture_rules()
    ext = file_extension(S.OBJECT)
    return events(spark, d).select(
        S.ID, ext.alias("file_extension"),
        high_risk_extension_flag(ext, r.high_risk_extensions).alias("is_high_risk_extension"),
    )


def q_sensitive_keyword(spark, d):
    r = fixture_rules()
    return events(spark, d).select(
        S.ID, S.OBJECT, keyword_flag(base_name(S.OBJECT), r.sensitive_keywords).alias("file_name_has_sensitive_keyword")
    )


def q_sensitive_keyword_join(spark, d):
    kw = load_dictionary(spark, packaged_path("sensitive_keywords.csv"), "keyword")
    ev = events(spark, d).select(S.ID, S.OBJECT)
    return rows_containing_any(ev, F.lower(base_name(S.OBJECT)), kw, key_cols=[S.ID])


def q_risky_domain(spark, d):
    r = fixture_rules()
    return events(spark, d).select(
        S.ID, S.DOMAIN, risky_domain_flag(S.DOMAIN, r.risky_domains).alias("is_risky_target_domain")
    )


def q_time_flags(spark, d):
    return time_flags(events(spark, d), fixture_rules()).select(
        S.ID, S.TS, "hour", "is_after_hours", "day_of_week", "is_monday_or_friday"
    )


def q_high_risk_position(spark, d):
    r = fixture_rules()
    return events(spark, d).select(
        S.ID, S.POSITION, high_risk_position_flag(S.POSITION, r.high_risk_positions).alias("is_high_risk_position")
    )


def q_parse_timestamps(spark, d):
    text = F.when(F.pmod(F.col(S.ID), F.lit(11)) == 0, F.lit("not a time")).otherwise(
        F.when(F.pmod(F.col(S.ID), F.lit(3)) == 0, F.date_format(S.TS, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(
            F.date_format(S.TS, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        )
    )
    ev = events(spark, d).select(S.ID, text.alias("ts_text"))
    return ev.withColumn("parsed_ts", parse_timestamp("ts_text"))


def q_rule_risk_score(spark, d):
    f = rule_score(row_features(spark, d))
    return f.select(S.ID, "risk_score", rule_label("risk_score").alias("rule_label"), S.LABEL)


# --- windows ----------------------------------------------------------------

def q_rolling_upload_count(spark, d):
    return features(spark, d).select(S.ID, S.USER, S.TS, "user_upload_count_24h")


def q_rolling_unique_domains(spark, d):
    return features(spark, d).select(S.ID, "user_unique_domains_7d")


def q_first_time_domain(spark, d):
    return features(spark, d).select(S.ID, S.DOMAIN, "is_first_time_domain")


# --- filters / lookups --------------------------------------------------------

def q_flagged_double_ext(spark, d):
    return reports.flag_equals(clean_features(spark, d), "double_extension_check", 1)


def q_burst_uploads(spark, d):
    return reports.above(clean_features(spark, d), "user_upload_count_24h", BURST_THRESHOLD)


def q_masked_pdf(spark, d):
    return reports.name_contains(events(spark, d), ".pdf.")


def q_recent_events(spark, d):
    ev = events(spark, d)
    return reports.recent(ev, 24, reports.latest_timestamp(ev))


def q_events_on_day(spark, d):
    ev = events(spark, d)
    return reports.on_day(ev, reports.latest_timestamp(ev))


def q_false_negatives(spark, d):
    return reports.missed_incidents(rule_predictions(spark, d))


def q_flagged_events(spark, d):
    return reports.flagged(rule_predictions(spark, d))


def q_event_by_id(spark, d):
    return reports.by_id(clean_features(spark, d), LOOKUP_ID)


def q_top_risk_events(spark, d):
    return reports.top_k(rule_predictions(spark, d), TOP_K)


# --- aggregates ---------------------------------------------------------------

def q_table_counts(spark, d):
    return reports.completeness(events(spark, d))


def q_label_distribution(spark, d):
    return reports.label_distribution(clean_features(spark, d))


def q_next_action_id(spark, d):
    return reports.next_id(events(spark, d))


def q_scoring_summary(spark, d):
    return reports.scoring_summary(rule_predictions(spark, d))


def q_distinct_domains(spark, d):
    return reports.distinct_values(events(spark, d), S.DOMAIN)


def q_position_risk_pairs(spark, d):
    return reports.distinct_values(row_features(spark, d), S.POSITION, "is_high_risk_position")


def q_high_risk_positions_seen(spark, d):
    """Distinct roles that the role rule flagged."""
    flagged_rows = reports.flag_equals(row_features(spark, d), "is_high_risk_position", 1)
    return reports.distinct_values(flagged_rows, S.POSITION)


# --- set operations / increments ------------------------------------------------

def q_union_event_versions(spark, d):
    ev = events(spark, d)
    v1 = ev.where(F.col(S.TS) < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    v2 = ev.where(F.col(S.TS) >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return v1.unionByName(v2).dropDuplicates([S.ID])


def _shifted(ev: DataFrame, hours: int):
    return reports.latest_timestamp(ev) - F.make_dt_interval(F.lit(0), F.lit(hours))


def q_union_all_versions(spark, d):
    """Both event versions with every copy kept."""
    ev = events(spark, d)
    v1 = ev.where(F.col(S.TS) < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    v2 = ev.where(F.col(S.TS) >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return v1.unionByName(v2)


def q_append_dedup(spark, d):
    """A table after two appends of overlapping batches and one repeat, read back."""
    ev = events(spark, d).select(S.ID, S.TS, S.USER)
    name = f"append_dedup_{uuid.uuid4().hex}"
    for batch in (ev.where(F.pmod(F.col(S.ID), F.lit(3)) != 0), ev, ev.unionByName(ev)):
        increment.append_new(spark, batch, name)
    return taken(spark, name).select(*ev.columns)


def taken(spark: SparkSession, *names: str) -> DataFrame:
    """A copy of the first table; all of ``names`` are dropped."""
    rows = spark.table(names[0]).checkpoint(eager=True)
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows


def q_new_events_anti(spark, d):
    ev = events(spark, d)
    target = ev.where(F.col(S.TS) < _shifted(ev, 24))
    batch = ev.where(F.col(S.TS) >= _shifted(ev, 48)).unionByName(ev.where(F.col(S.TS) >= _shifted(ev, 6)))
    return increment.new_rows(batch, target)


def q_new_events_filtered(spark, d):
    """The same ingest step when the batch is small beside the history: its key
    range and a Bloom filter of its keys are applied to the history's scan."""
    ev = events(spark, d)
    target = ev.where(F.col(S.TS) < _shifted(ev, 24))
    return increment.new_rows(ev.where(F.col(S.TS) >= _shifted(ev, 48)), target, prune_to_batch_range=True)


def q_risky_domain_join(spark, d):
    """Risky destinations by a list held as a table, of any length."""
    listed = load_dictionary(spark, packaged_path("risky_domains.csv"), "Domain")
    return flag_risky_domains(events(spark, d), listed, "is_risky_target_domain").select(S.ID, S.DOMAIN, "is_risky_target_domain")


def q_unscored_events(spark, d):
    # The run's "now" is the latest source event (a one-column scan), not a
    # max over the feature table, which would recompute its windows.
    ev = events(spark, d)
    ft = clean_features(spark, d)
    table = written_predictions(spark, ev, ft)
    out = increment.unscored_since(ft, spark, table, _shifted(ev, 72)).checkpoint(eager=True)
    spark.sql(f"DROP TABLE {table}")
    return out


def written_predictions(spark: SparkSession, ev: DataFrame, ft: DataFrame) -> str:
    """A predictions table of its own name that a run a day ago left: every
    event before the last 24 hours is scored."""
    name = f"predictions_{uuid.uuid4().hex}"
    append_dated(predictions_from(ft).where(F.col(S.TS) < _shifted(ev, 24)), name)
    return name


def q_ingest_outcomes(spark, d):
    """Where the rows of a batch with unreadable and missing times, missing
    ids and repeated rows go, over two runs of it: counts by outcome."""
    ev = events(spark, d)
    text = F.date_format(S.TS, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    bad = F.when(F.pmod(F.col(S.ID), F.lit(50)) == 3, F.lit("not a time")).when(F.pmod(F.col(S.ID), F.lit(50)) != 4, text)
    batch = ev.withColumn(S.TS, bad).withColumn(S.ID, F.when(F.pmod(F.col(S.ID), F.lit(50)) != 5, F.col(S.ID)))
    batch = batch.unionByName(batch)
    name = f"ingest_{uuid.uuid4().hex}"
    appended = sum(jobs.ingest_job(spark, batch, name) for _ in range(2))
    rejects = spark.table(jobs.rejects_table(name)).groupBy(F.col("reason").alias("outcome")).agg(F.sum("n_rows").alias("n_rows")).checkpoint(eager=True)
    stored = taken(spark, name, jobs.rejects_table(name)).select(F.lit("appended").alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n_rows"))
    return rejects.union(stored).unionByName(spark.createDataFrame([("returned", appended)], "outcome string, n_rows long"))


def q_overwrite_readback(spark, d):
    """A dated table replaced by rows that are read from it, read back: it is
    listed, holds the new rows alone, and is gone after DROP."""
    ev = events(spark, d)
    name = f"overwrite_{uuid.uuid4().hex}"
    overwrite_dated(ev, name)
    overwrite_dated(spark.table(name).where(F.pmod(F.col(S.ID), F.lit(4)) != 0), name, reads_target=True)
    listed = name in list_tables(spark) and table_exists(spark, name)
    out = taken(spark, name)
    return out.select(S.ID, S.TS, "event_date", F.lit(listed).alias("listed"), F.lit(table_exists(spark, name)).alias("left_over"))


def q_daily_features(spark, d):
    """The feature table built from a dated event table by increments of ten days."""
    name = f"daily_{uuid.uuid4().hex}"
    overwrite_dated(events(spark, d), f"{name}_events")
    first, last = spark.table(f"{name}_events").agg(F.min("event_date"), F.max("event_date")).first()
    while first <= last:
        until = min(first + dt.timedelta(days=9), last)
        daily.daily_job(spark, f"{name}_events", name, first.isoformat(), fixture_rules(), last=until.isoformat())
        first = until + dt.timedelta(days=1)
    return taken(spark, name, f"{name}_events", f"{name}_first_uses").select(*S.FEATURE_TABLE_COLUMNS)


# --- approximate windows ----------------------------------------------------------

def q_approx_unique_domains(spark, d):
    """Rolling distinct domains from sketches, which are exact while an account has few domains."""
    return approx_distinct_window(events(spark, d)).select(S.ID, F.col(APPROX_COL).alias("user_unique_domains_7d"))


# --- metrics ------------------------------------------------------------------

def q_auc_roc(spark, d):
    return metrics.auc_roc(scored(spark, d))


def q_average_precision(spark, d):
    return metrics.average_precision(scored(spark, d))


def q_pr_curve(spark, d):
    return metrics.pr_curve(scored(spark, d))


def q_roc_curve(spark, d):
    return metrics.roc_curve(scored(spark, d))


def q_best_f1_threshold(spark, d):
    return metrics.best_f1_threshold(scored(spark, d))


def q_confusion_matrix(spark, d):
    return metrics.confusion_matrix(scored(spark, d))


def q_precision_recall(spark, d):
    return metrics.precision_recall(scored(spark, d))


def q_classification_report(spark, d):
    return metrics.classification_report(scored(spark, d))


def q_model_comparison(spark, d):
    return metrics.model_comparison(two_models(spark, d), "rule", "rule_noisy")


def q_ranking_bounds(spark, d):
    """Bounds on AUC and average precision from a histogram of 16 bins."""
    return metrics.ranking_bounds(metrics.score_histogram(scored(spark, d), n_bins=16))


# --- model preparation ----------------------------------------------------------

def q_stratified_split(spark, d):
    ft = clean_features(spark, d).select(S.ID, S.LABEL)
    return stratified_split(ft)


def q_three_way_split(spark, d):
    ft = clean_features(spark, d).select(S.ID, S.LABEL)
    return stratified_split(ft, validation_fraction=0.2)




# --- models (Spark ML) -----------------------------------------------------------

_MODELS: dict[tuple, object] = {}


def _model(spark, d, kind: str):
    """Train once per Spark application, folder and kind; later queries reuse
    the fit (the application id is unique, so a new context never sees a
    model bound to a stopped one)."""
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _MODELS:
        if kind == "gbt":
            split_df = training.split_features(clean_features(spark, d))
            _MODELS[key] = (training.train(split_df), split_df)
        else:
            split_df = training.split_features(clean_features(spark, d), validation_fraction=0.2)
            model, best_k, _ = training.train_early_stop(split_df, codes="statistics")
            _MODELS[key] = (model, split_df)
    return _MODELS[key]


def q_encode_features(spark, d):
    """Codes fitted on one half of the ids and applied to all: values that the
    half does not have get -1, and a null (every 50th role) is a value."""
    ft = clean_features(spark, d)
    ft = ft.withColumn(S.POSITION, F.when(F.pmod(F.col(S.ID), F.lit(50)) != 0, F.col(S.POSITION)))
    # An extension of its own for every 40th row, half of them unseen.
    own = F.concat(F.lit("x"), F.pmod(F.col(S.ID), F.lit(400)).cast("string"))
    ft = ft.withColumn("file_extension", F.when(F.pmod(F.col(S.ID), F.lit(40)) == 1, own).otherwise(F.col("file_extension")))
    seen = F.pmod(F.floor(F.col(S.ID) / 40), F.lit(2)) == 0
    enc = encode(ft, fit_encoder(ft.where(seen)))
    return enc.select(S.ID, "ActionType_code", "file_extension_code", "Position_code")


def q_ordered_statistics(spark, d):
    """Codes of the training order: each from the labels of earlier rows of the same value."""
    ft = clean_features(spark, d)
    encoder = fit_target_encoder(ft, [S.USER, S.POSITION])
    out = ordered_statistics(ft, encoder)
    return out.select(S.ID, F.col(f"{S.USER}_code").alias("user_code"), F.col(f"{S.POSITION}_code").alias("position_code"))


def q_target_statistics(spark, d):
    """Codes of rows to score, fitted on the ids of an even hundred."""
    ft = clean_features(spark, d)
    seen = F.pmod(F.floor(F.col(S.ID) / 100), F.lit(2)) == 0
    out = fit_target_encoder(ft.where(seen), [S.USER, S.POSITION]).encode(ft)
    return out.select(S.ID, F.col(f"{S.USER}_code").alias("user_code"), F.col(f"{S.POSITION}_code").alias("position_code"))


def q_importance_properties(spark, d):
    """Property: importances are not negative and add up to 1."""
    out = q_feature_importance(spark, d)
    total = out.agg(F.abs(F.sum("importance") - 1) < 1e-9).first()[0]
    return out.select("feature", (F.col("importance") >= 0).alias("not_negative"), F.lit(total).alias("sums_to_one"))


def q_model_roundtrip(spark, d):
    """Property by id: the model read back from its folder predicts the same."""
    model, split_df = _model(spark, d, "gbt")
    path = f"{ensure_checkpoint_dir(spark)}/model_roundtrip-{uuid.uuid4().hex}"
    save_model(model, path)
    a = predict(model, split_df).select(S.ID, F.col("raw_prob").alias("before"))
    b = predict(load_model(path), split_df).select(S.ID, F.col("raw_prob").alias("after"))
    return a.join(b, S.ID).select(S.ID, (F.col("before") == F.col("after")).alias("same"))


def q_explain_additivity(spark, d):
    """Property by id, on all rows: base and contributions add up to the
    model's own margin, with one contribution for each of its inputs."""
    model, split_df = _model(spark, d, "gbt")
    parts = explain(model, split_df).groupBy(S.ID).agg(
        F.count(F.lit(1)).alias("n_inputs"), F.sum("shap_value").alias("s"), F.first("base_value").alias("b"), F.first("margin").alias("m")
    )
    return parts.select(S.ID, "n_inputs", (F.abs(F.col("s") + F.col("b") - F.col("m")) < 1e-6).alias("adds_up"))


def q_score_new_ids(spark, d):
    """Property: the ids and versions that a scoring run takes."""
    return q_score_new_events(spark, d).select(S.ID, S.TS, S.LABEL, "scored_at", "model_version")


def q_gbt_predictions(spark, d):
    model, split_df = _model(spark, d, "gbt")
    return training.test_predictions(model, split_df).select(S.ID, S.LABEL, "predicted", "predicted_prob")


def q_gbt_early_stop(spark, d):
    model, split_df = _model(spark, d, "early_stop")
    pred = training.test_predictions(model, split_df)
    return pred.select(S.ID, S.LABEL, "predicted", "predicted_prob",
                       F.lit(booster(model).getNumTrees).alias("n_trees"))


def q_gbt_continued(spark, d):
    """Early stop without a second fit: trees from histograms, grown on ten at a
    time until ten in a row do not raise the validation AUC (at most 60)."""
    split_df = training.split_features(clean_features(spark, d), validation_fraction=0.2)
    model, best_k, _ = training.train_continued(split_df, BoostParams(max_iter=60), patience=10, check_every=10, codes="statistics")
    pred = training.test_predictions(model, split_df)
    return pred.select(S.ID, S.LABEL, "predicted", "predicted_prob", F.lit(best_k).alias("n_trees"))


def q_split_gains(spark, d):
    """Every possible first split of the number columns: rows and label-1 rows
    at or below the bound, and the drop in variance, from the histograms of all rows."""
    bounds = {c: [0.0] for c in S.NUMERIC_COLS}
    bounds |= {"day_of_week": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], "user_upload_count_24h": [1.0, 2.0, 3.0, 5.0, 10.0], "user_unique_domains_7d": [1.0, 2.0, 3.0, 4.0]}
    rows = clean_features(spark, d).withColumn("fits", F.lit(True))
    fit = Boosting(rows, list(bounds), S.LABEL, bounds=list(bounds.values()))
    out = spark.createDataFrame(fit.root_gains(), "feature string, bound double, n_left long, positives_left long, gain double")
    return out.withColumn("gain", F.round("gain", 6))


def q_score_new_events(spark, d):
    model, _ = _model(spark, d, "gbt")
    ft = clean_features(spark, d)
    ev = events(spark, d)
    table = written_predictions(spark, ev, ft)
    batch = scoring.pending(spark, ft, table, 72, reports.latest_timestamp(ev)).checkpoint(eager=True)
    spark.sql(f"DROP TABLE {table}")
    return scoring.score_events(model, batch, "gbt_v1", SCORED_AT)


def q_feature_importance(spark, d):
    model, _ = _model(spark, d, "gbt")
    rows = feature_importance(model)
    return spark.createDataFrame(rows, "feature string, importance double")


def q_explain_events(spark, d):
    model, split_df = _model(spark, d, "gbt")
    return explain(model, split_df)


def q_feature_importance_comparison(spark, d):
    """Importances of the two boosted models side by side, by the first."""
    a, _ = _model(spark, d, "gbt")
    b, _ = _model(spark, d, "early_stop")
    ia, ib = dict(feature_importance(a)), dict(feature_importance(b))
    rows = [(f, ia[f], ib.get(f, 0.0)) for f in ia]
    # One row per model input (bounded by the feature count).
    return spark.createDataFrame(rows, "feature string, gbt double, gbt_early_stop double").orderBy(
        F.col("gbt").desc(), "feature"
    )


def q_explain_events_wide(spark, d):
    """One row per event with its contributions sorted, largest first."""
    model, split_df = _model(spark, d, "gbt")
    return explain(model, split_df, layout="wide")


def _test_scores(spark, d, kind: str, name: str) -> DataFrame:
    model, split_df = _model(spark, d, kind)
    pred = training.test_predictions(model, split_df)
    return pred.select(
        F.lit(name).alias("model"), F.col(S.ID).alias("id"), F.col(S.LABEL).cast("int").alias("label"),
        F.col("raw_prob").alias("score"), "predicted",
    )


def q_gbt_model_comparison(spark, d):
    """The 100-tree model against the early-stopped one on the same test rows."""
    both = _test_scores(spark, d, "gbt", "gbt").unionByName(_test_scores(spark, d, "early_stop", "gbt_early_stop"))
    return metrics.model_comparison(both, "gbt", "gbt_early_stop")


def q_gbt_tuned_threshold(spark, d):
    """Best-F1 threshold of the boosted model on its test rows."""
    return metrics.best_f1_threshold(_test_scores(spark, d, "gbt", "gbt"))


def q_gbt_validation_threshold(spark, d):
    """Threshold tuned on validation rows, confusion counts on test rows."""
    model, split_df = _model(spark, d, "early_stop")
    return training.tuned_threshold(model, split_df, tune_on="validation")


QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
