"""Column names and schemas of the event, feature and prediction tables."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "Action_ID"
TS = "Timestamp"
ACTION = "ActionType"
OBJECT = "ObjectName"
DOMAIN = "Target_Domain"
USER = "AccountDisplayName"
POSITION = "Position"
LABEL = "Risk_Label"

# Raw upload events (one row per upload).
UPLOAD_EVENT_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField(TS, T.TimestampNTZType()),
        T.StructField(ACTION, T.StringType()),
        T.StructField(OBJECT, T.StringType()),
        T.StructField(DOMAIN, T.StringType()),
        T.StructField(USER, T.StringType()),
        T.StructField(POSITION, T.StringType()),
        T.StructField(LABEL, T.LongType()),
    ]
)
UPLOAD_EVENT_COLUMNS = [f.name for f in UPLOAD_EVENT_SCHEMA.fields]

CATEGORICAL_COLS = [ACTION, "file_extension", POSITION]
NUMERIC_COLS = [
    "is_high_risk_extension",
    "file_name_has_sensitive_keyword",
    "double_extension_check",
    "is_risky_target_domain",
    "is_first_time_domain",
    "is_after_hours",
    "day_of_week",
    "is_monday_or_friday",
    "is_high_risk_position",
    "user_upload_count_24h",
    "user_unique_domains_7d",
]
FEATURE_COLS = CATEGORICAL_COLS + NUMERIC_COLS

# The 20 columns of the feature table, in order.
FEATURE_TABLE_COLUMNS = [
    LABEL,
    ID,
    USER,
    OBJECT,
    DOMAIN,
    TS,
    ACTION,
    "file_extension",
    POSITION,
    "is_high_risk_extension",
    "file_name_has_sensitive_keyword",
    "double_extension_check",
    "is_risky_target_domain",
    "is_first_time_domain",
    "is_after_hours",
    "day_of_week",
    "is_monday_or_friday",
    "is_high_risk_position",
    "user_upload_count_24h",
    "user_unique_domains_7d",
]

# The 11 columns of the predictions table, in order.
PREDICTION_COLUMNS = [
    ID,
    TS,
    USER,
    OBJECT,
    DOMAIN,
    POSITION,
    LABEL,
    "predicted",
    "predicted_prob",
    "scored_at",
    "model_version",
]


def check_columns(df, required: list[str], what: str) -> None:
    """Fail early with a clear message when an input lacks a column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; has {df.columns}")
