"""Row-level rule features (no shuffle: one Project over the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import RiskRules
from leakwatch.functions.context import (
    after_hours_flag,
    day_of_week,
    high_risk_position_flag,
    risky_day_flag,
    risky_domain_flag,
)
from leakwatch.functions.files import (
    base_name,
    double_extension_flag,
    file_extension,
    high_risk_extension_flag,
    keyword_flag,
)
from leakwatch.functions.patterns import clean_entries
from leakwatch.operators.dictionary_match import flag_containing_any
from leakwatch.sources.dictionaries import MAX_PATTERN_ENTRIES


def add_file_features(df: DataFrame, rules: RiskRules, keep_base: bool = False) -> DataFrame:
    """file_extension, double_extension_check, is_high_risk_extension,
    file_name_has_sensitive_keyword (and ``file_name`` when ``keep_base``)."""
    out = df.withColumns({"file_extension": file_extension(S.OBJECT), "file_name": base_name(S.OBJECT)})
    out = out.withColumns(
        {
            "double_extension_check": double_extension_flag(
                "file_name", rules.double_extensions, strict=rules.strict_double_extension
            ),
            "is_high_risk_extension": high_risk_extension_flag("file_extension", rules.high_risk_extensions),
        }
    )
    keywords, flag = clean_entries(rules.sensitive_keywords), "file_name_has_sensitive_keyword"
    if len(keywords) <= MAX_PATTERN_ENTRIES:
        out = out.withColumn(flag, keyword_flag("file_name", keywords))
    else:  # too long for a pattern in the plan: match the names by a join
        entries = df.sparkSession.createDataFrame([(k,) for k in keywords], "value string")
        out = flag_containing_any(out, F.lower("file_name"), entries, flag)
    return out if keep_base else out.drop("file_name")


def add_risky_domain(df: DataFrame, rules: RiskRules) -> DataFrame:
    """is_risky_target_domain, for a domain list of any length."""
    domains, flag = clean_entries(rules.risky_domains), "is_risky_target_domain"
    if len(domains) <= MAX_PATTERN_ENTRIES:
        return df.withColumn(flag, risky_domain_flag(S.DOMAIN, domains, rules.domain_match))
    entries = df.sparkSession.createDataFrame([(d,) for d in domains], "value string")
    return flag_risky_domains(df, entries, flag, rules.domain_match)


def flag_risky_domains(df: DataFrame, domains: DataFrame, out_col: str, mode: str = "substring") -> DataFrame:
    """``risky_domain_flag`` for a list held as a table (``value``, lower case):
    matched through the index of ``operators.gram_index``, not by a pattern."""
    d, value = F.lower(S.DOMAIN), F.col("value")
    if mode == "suffix":  # whole labels up to the end: both get a dot before and an end mark
        marked = lambda c: F.concat(F.lit("."), c, F.lit("\n"))
        d, value = marked(d), F.when(F.length(value) > 0, marked(value))
    elif mode != "substring":
        raise ValueError(f"unknown domain match mode {mode!r}")
    return flag_containing_any(df, d, domains.select(value.alias("value")), out_col)


def add_context_features(df: DataFrame, rules: RiskRules) -> DataFrame:
    """Destination, time and role flags."""
    out = add_risky_domain(df, rules).withColumns(
        {
            "is_after_hours": after_hours_flag(S.TS, rules.after_hours_from, rules.after_hours_until),
            "day_of_week": day_of_week(S.TS),
            "is_high_risk_position": high_risk_position_flag(S.POSITION, rules.high_risk_positions),
        }
    )
    return out.withColumn("is_monday_or_friday", risky_day_flag("day_of_week", rules.risky_days))


def add_row_features(df: DataFrame, rules: RiskRules) -> DataFrame:
    """All per-row rule features."""
    S.check_columns(df, [S.OBJECT, S.DOMAIN, S.TS, S.POSITION], "add_row_features")
    return add_context_features(add_file_features(df, rules), rules)


def time_flags(df: DataFrame, rules: RiskRules) -> DataFrame:
    """Hour, after-hours flag, day of week and Monday/Friday flag."""
    return df.withColumns(
        {
            "hour": F.hour(S.TS).cast("int"),
            "is_after_hours": after_hours_flag(S.TS, rules.after_hours_from, rules.after_hours_until),
            "day_of_week": day_of_week(S.TS),
        }
    ).withColumn("is_monday_or_friday", risky_day_flag("day_of_week", rules.risky_days))
