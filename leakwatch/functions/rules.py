"""Weighted rule risk score, computed in exact integer hundredths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leakwatch.config import RuleWeights


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_score_hundredths(
    risky_domain: str | Column,
    sensitive_file: str | Column,
    ts: str | Column,
    high_risk_role: str | Column,
    risky_day: str | Column,
    weights: RuleWeights = RuleWeights(),
) -> Column:
    """Sum of the rule weights, as an int in hundredths (0.35 → 35).

    Integer arithmetic keeps rows that sit exactly on the threshold stable;
    a float sum would decide them by the order of addition.
    """
    h = F.hour(_col(ts))
    w = weights
    return (
        F.when(_col(risky_domain) == 1, w.risky_domain).otherwise(w.safe_domain)
        + F.when(_col(sensitive_file) == 1, w.sensitive_file).otherwise(w.plain_file)
        + F.when((h < w.off_hours_before) | (h >= w.off_hours_from), w.off_hours).otherwise(0)
        + F.when(_col(high_risk_role) == 1, w.high_risk_role).otherwise(0)
        + F.when(_col(risky_day) == 1, w.monday_friday).otherwise(0)
    ).cast("int")


def rule_label(score_hundredths: str | Column, weights: RuleWeights = RuleWeights()) -> Column:
    """1 when the score is strictly above the threshold."""
    return F.when(_col(score_hundredths) > weights.threshold, 1).otherwise(0).cast("int")


def rule_probability(score_hundredths: str | Column) -> Column:
    """The score as a fraction (hundredths / 100), used as a ranking score."""
    return (_col(score_hundredths).cast("double") / F.lit(100.0))
