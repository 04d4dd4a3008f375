"""Raw upload events → the 20-column feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leakwatch import schemas as S
from leakwatch.config import RiskRules
from leakwatch.operators.behaviour import user_behaviour
from leakwatch.operators.features import add_row_features


def build_features(events: DataFrame, rules: RiskRules, strategy: str = "auto") -> DataFrame:
    """All features on every event (no row dropped yet)."""
    S.check_columns(events, S.UPLOAD_EVENT_COLUMNS, "build_features")
    rows = add_row_features(events, rules)
    return user_behaviour(
        rows,
        count_seconds=rules.count_window_seconds,
        distinct_seconds=rules.distinct_window_seconds,
        strategy=strategy,
    )


def feature_table(events: DataFrame, rules: RiskRules, strategy: str = "auto") -> DataFrame:
    """The clean feature table: 20 columns in fixed order, rows with any null dropped.

    Rows are dropped after the windows, so an event with a missing file name
    still counts in its neighbours' rolling counts.
    """
    return build_features(events, rules, strategy).select(*S.FEATURE_TABLE_COLUMNS).na.drop(how="any")
