"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the pre-registered
``events`` view, with the fixture lists as inline VALUES tables.
"""

from __future__ import annotations

FEATURE_COLS = [
    "Risk_Label", "Action_ID", "AccountDisplayName", "ObjectName", "Target_Domain", "Timestamp",
    "ActionType", "file_extension", "Position", "is_high_risk_extension", "file_name_has_sensitive_keyword",
    "double_extension_check", "is_risky_target_domain", "is_first_time_domain", "is_after_hours",
    "day_of_week", "is_monday_or_friday", "is_high_risk_position", "user_upload_count_24h",
    "user_unique_domains_7d",
]


def _q(c: str) -> str:
    return f'"{c}"'


def _values(items: list[str]) -> str:
    return ", ".join(f"({i}, '{v}')" for i, v in enumerate(items))


STEMS = ["client_list", "lunch_menu", "payroll_run", "classnotes", "team_photo", "budget.CSV", "report.pdf",
         "v1.pyramid", "meeting_notes", "api_token", "Statement_May", "README"]
SUFFIXES = [".csv", ".pdf", ".XLSX", ".zip", ".docx", "", ".png"]
DOMAINS = ["mail.corp.example", "wiki.corp.example", "crm.corp.example", "hr.corp.example", "files.corp.example",
           "share.partner.example", "drop.files.example", "quickshare.example", "notquickshare.example",
           "chat.social.example", "vendor.example", "mirror.partner.example", "DROP.Files.Example"]
POSITIONS = ["Analyst", "Branch Teller", "Credit Officer", "Senior Credit Officer", "Data Engineer",
             "Portfolio Manager"]

DOMAIN_RE = r"drop\.files\.example|quickshare\.example|social\.example"
KEYWORD_RE = "client|payroll|token|statement|ssn"
ROLE_RE = "credit officer|portfolio manager"
DOUBLE_RE = r"\.(pdf|csv|py|zip)"
BASE = r"regexp_replace(ObjectName, '\.[^.]+$', '')"

UE = f"""
ue_raw AS (
  SELECT CAST(e.event_id AS BIGINT) AS Action_ID, e.ts AS "Timestamp", e.event_type AS ActionType,
         CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE st.v || sx.v END AS ObjectName,
         dm.v AS Target_Domain, 'User_' || CAST(e.user_id AS VARCHAR) AS AccountDisplayName, ps.v AS Position
  FROM events e
  JOIN (VALUES {_values(STEMS)}) st(i, v) ON st.i = e.event_id % 12
  JOIN (VALUES {_values(SUFFIXES)}) sx(i, v) ON sx.i = e.event_id % 7
  JOIN (VALUES {_values(DOMAINS)}) dm(i, v) ON dm.i = (e.event_id * 7 + e.user_id) % 13
  JOIN (VALUES {_values(POSITIONS)}) ps(i, v) ON ps.i = e.user_id % 6
),
ue AS (
  SELECT Action_ID, "Timestamp", ActionType, ObjectName, Target_Domain, AccountDisplayName, Position,
         CAST(CASE WHEN hs + (Action_ID * 31) % 41 - 20 > 35 THEN 1 ELSE 0 END AS BIGINT) AS Risk_Label
  FROM (
    SELECT *,
      (CASE WHEN regexp_matches(lower(Target_Domain), '{DOMAIN_RE}') THEN 35 ELSE -10 END)
      + (CASE WHEN regexp_matches(lower({BASE}), '{KEYWORD_RE}') THEN 30 ELSE -5 END)
      + (CASE WHEN hour("Timestamp") < 8 OR hour("Timestamp") >= 19 THEN 15 ELSE 0 END)
      + (CASE WHEN regexp_matches(lower(Position), '{ROLE_RE}') THEN 8 ELSE 0 END)
      + (CASE WHEN dayofweek("Timestamp") + 1 IN (2, 6) THEN 5 ELSE 0 END) AS hs
    FROM ue_raw
  ) s
)"""

FEAT = """
feat0 AS (
  SELECT ue.*,
    lower(regexp_extract(ObjectName, '([^.]*)$', 1)) AS file_extension,
    regexp_replace(ObjectName, '\\.[^.]+$', '') AS file_name,
    CAST(floor(epoch("Timestamp")) AS BIGINT) AS sec
  FROM ue
),
feat AS (
  SELECT *,
    CAST(CASE WHEN regexp_matches(file_name, '__DOUBLE__') THEN 1 ELSE 0 END AS INTEGER) AS double_extension_check,
    CAST(CASE WHEN file_extension IN ('csv', 'pdf', 'xlsx', 'docx') THEN 1 ELSE 0 END AS INTEGER) AS is_high_risk_extension,
    CAST(CASE WHEN regexp_matches(lower(file_name), '__KEYWORD__') THEN 1 ELSE 0 END AS INTEGER) AS file_name_has_sensitive_keyword,
    CAST(CASE WHEN regexp_matches(lower(Target_Domain), '__DOMAIN__') THEN 1 ELSE 0 END AS INTEGER) AS is_risky_target_domain,
    CAST(CASE WHEN hour("Timestamp") >= 19 OR hour("Timestamp") <= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_after_hours,
    CAST(dayofweek("Timestamp") + 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN dayofweek("Timestamp") + 1 IN (2, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_monday_or_friday,
    CAST(CASE WHEN regexp_matches(lower(Position), '__ROLE__') THEN 1 ELSE 0 END AS INTEGER) AS is_high_risk_position,
    CAST(count(*) OVER (PARTITION BY AccountDisplayName ORDER BY sec
         RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS BIGINT) AS user_upload_count_24h,
    CAST(count(DISTINCT Target_Domain) OVER (PARTITION BY AccountDisplayName ORDER BY sec
         RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS BIGINT) AS user_unique_domains_7d,
    CAST(CASE WHEN rank() OVER (PARTITION BY AccountDisplayName, Target_Domain ORDER BY sec) = 1
         THEN 1 ELSE 0 END AS INTEGER) AS is_first_time_domain
  FROM feat0
)""".replace("__DOUBLE__", DOUBLE_RE).replace("__KEYWORD__", KEYWORD_RE).replace(
    "__DOMAIN__", DOMAIN_RE).replace("__ROLE__", ROLE_RE)

FT = f"""
ft AS (
  SELECT {", ".join(_q(c) for c in FEATURE_COLS)} FROM feat
  WHERE {" AND ".join(_q(c) + " IS NOT NULL" for c in FEATURE_COLS)}
)"""

PRED = """
ft_hs AS (
  SELECT *,
    (CASE WHEN is_risky_target_domain = 1 THEN 35 ELSE -10 END)
    + (CASE WHEN file_name_has_sensitive_keyword = 1 THEN 30 ELSE -5 END)
    + (CASE WHEN hour("Timestamp") < 8 OR hour("Timestamp") >= 19 THEN 15 ELSE 0 END)
    + (CASE WHEN is_high_risk_position = 1 THEN 8 ELSE 0 END)
    + (CASE WHEN is_monday_or_friday = 1 THEN 5 ELSE 0 END) AS hs
  FROM ft
),
pred AS (
  SELECT Action_ID, "Timestamp", AccountDisplayName, ObjectName, Target_Domain, Position, Risk_Label,
    CAST(CASE WHEN hs > 35 THEN 1 ELSE 0 END AS INTEGER) AS predicted,
    CAST(hs AS DOUBLE) / 100.0 AS predicted_prob,
    TIMESTAMP '2024-02-01 00:00:00' AS scored_at,
    'rule_v1' AS model_version
  FROM ft_hs
),
scored AS (
  SELECT Action_ID AS id, CAST(Risk_Label AS INTEGER) AS label, predicted_prob AS score, predicted FROM pred
)"""

# Curve points per distinct score, descending: tp/fp at or above the score.
CURVE = """
sc AS (
  SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM scored GROUP BY score
),
tot AS (SELECT CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM sc),
curve AS (
  SELECT score AS threshold, pos, neg,
         CAST(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
         P, N
  FROM sc, tot
),
pts AS (
  SELECT *,
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
    CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) ELSE 1.0 END AS recall
  FROM curve
)"""

CONFUSION = """
cm AS (
  SELECT CAST(sum(CASE WHEN label = 0 AND predicted = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN label = 0 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN label = 1 AND predicted = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN label = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scored
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


BASE_UE = _with(UE)
BASE_FEAT = _with(UE, FEAT)
BASE_FT = _with(UE, FEAT, FT)
BASE_PRED = _with(UE, FEAT, FT, PRED)
BASE_CURVE = _with(UE, FEAT, FT, PRED, CURVE)
BASE_CM = _with(UE, FEAT, FT, PRED, CONFUSION)

FT_COLS = ", ".join(_q(c) for c in FEATURE_COLS)
UE_COLS = 'Action_ID, "Timestamp", ActionType, ObjectName, Target_Domain, AccountDisplayName, Position, Risk_Label'
PRED_COLS = ('Action_ID, "Timestamp", AccountDisplayName, ObjectName, Target_Domain, Position, Risk_Label, '
             "predicted, predicted_prob, scored_at, model_version")
MAX_TS = '(SELECT max("Timestamp") FROM ue)'


def _split_sql(validation_fraction: float) -> str:
    return BASE_FT + f"""
, r AS (
  SELECT Action_ID, Risk_Label,
    row_number() OVER (PARTITION BY Risk_Label ORDER BY md5('42:' || CAST(Action_ID AS VARCHAR)), Action_ID) AS rk,
    count(*) OVER (PARTITION BY Risk_Label) AS n
  FROM ft
), k AS (
  SELECT *, round(0.2 * n) AS n_test FROM r
)
SELECT Action_ID, Risk_Label,
  CASE WHEN rk <= n_test THEN 'test'
       WHEN rk <= n_test + round({validation_fraction} * (n - n_test)) THEN 'validation'
       ELSE 'train' END AS split
FROM k"""


ORACLE = {
    "scan_events": BASE_UE + f"SELECT {UE_COLS} FROM ue",
    "feature_table": BASE_FT + f"SELECT {FT_COLS} FROM ft",
    "feature_table_bucketed": BASE_FT + f"SELECT {FT_COLS} FROM ft",
    "drop_incomplete": BASE_UE + f"SELECT {UE_COLS} FROM ue WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in UE_COLS.split(", ")),
    "file_parts": BASE_FEAT + "SELECT Action_ID, ObjectName, file_name, file_extension FROM feat",
    "double_extension": BASE_FEAT + "SELECT Action_ID, ObjectName, double_extension_check FROM feat",
    "high_risk_extension": BASE_FEAT + "SELECT Action_ID, file_extension, is_high_risk_extension FROM feat",
    "sensitive_keyword": BASE_FEAT + "SELECT Action_ID, ObjectName, file_name_has_sensitive_keyword FROM feat",
    "sensitive_keyword_join": BASE_FEAT + "SELECT Action_ID, ObjectName FROM feat WHERE EXISTS ("
    "SELECT 1 FROM (VALUES ('client'), ('payroll'), ('token'), ('statement'), ('ssn')) kw(v) "
    "WHERE instr(lower(file_name), kw.v) > 0)",
    "risky_domain": BASE_FEAT + "SELECT Action_ID, Target_Domain, is_risky_target_domain FROM feat",
    "risky_domain_join": BASE_FEAT + "SELECT Action_ID, Target_Domain, is_risky_target_domain FROM feat",
    "time_flags": BASE_FEAT + 'SELECT Action_ID, "Timestamp", CAST(hour("Timestamp") AS INTEGER) AS hour, '
    "is_after_hours, day_of_week, is_monday_or_friday FROM feat",
    "high_risk_position": BASE_FEAT + "SELECT Action_ID, Position, is_high_risk_position FROM feat",
    "parse_timestamps": BASE_UE + """, t AS (
  SELECT Action_ID, CASE WHEN Action_ID % 11 = 0 THEN 'not a time'
                         WHEN Action_ID % 3 = 0 THEN strftime("Timestamp", '%Y-%m-%dT%H:%M:%S.%gZ')
                         ELSE strftime("Timestamp", '%Y-%m-%dT%H:%M:%SZ') END AS ts_text FROM ue)
SELECT Action_ID, ts_text, coalesce(try_strptime(ts_text, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(ts_text, '%Y-%m-%dT%H:%M:%S.%gZ')) AS parsed_ts FROM t""",
    "rule_risk_score": BASE_FEAT + """SELECT Action_ID, CAST(hs AS INTEGER) AS risk_score,
  CAST(CASE WHEN hs > 35 THEN 1 ELSE 0 END AS INTEGER) AS rule_label, Risk_Label FROM (
  SELECT *, (CASE WHEN is_risky_target_domain = 1 THEN 35 ELSE -10 END)
    + (CASE WHEN file_name_has_sensitive_keyword = 1 THEN 30 ELSE -5 END)
    + (CASE WHEN hour("Timestamp") < 8 OR hour("Timestamp") >= 19 THEN 15 ELSE 0 END)
    + (CASE WHEN is_high_risk_position = 1 THEN 8 ELSE 0 END)
    + (CASE WHEN is_monday_or_friday = 1 THEN 5 ELSE 0 END) AS hs FROM feat) x""",
    "rolling_upload_count": BASE_FEAT
    + 'SELECT Action_ID, AccountDisplayName, "Timestamp", user_upload_count_24h FROM feat',
    "rolling_unique_domains": BASE_FEAT + "SELECT Action_ID, user_unique_domains_7d FROM feat",
    "first_time_domain": BASE_FEAT + "SELECT Action_ID, Target_Domain, is_first_time_domain FROM feat",
    "flagged_double_ext": BASE_FT + f"SELECT {FT_COLS} FROM ft WHERE double_extension_check = 1",
    "burst_uploads": BASE_FT + f"SELECT {FT_COLS} FROM ft WHERE user_upload_count_24h > 10",
    "masked_pdf": BASE_UE + f"SELECT {UE_COLS} FROM ue WHERE contains(ObjectName, '.pdf.')",
    "recent_events": BASE_UE + f'SELECT {UE_COLS} FROM ue WHERE "Timestamp" >= {MAX_TS} - INTERVAL 24 HOUR',
    "events_on_day": BASE_UE + f'SELECT {UE_COLS} FROM ue WHERE "Timestamp" >= date_trunc(\'day\', {MAX_TS}) '
    f'AND "Timestamp" < date_trunc(\'day\', {MAX_TS}) + INTERVAL 1 DAY ORDER BY Action_ID',
    "false_negatives": BASE_PRED + f"SELECT {PRED_COLS} FROM pred WHERE predicted = 0 AND Risk_Label = 1 "
    "ORDER BY predicted_prob DESC, Action_ID",
    "flagged_events": BASE_PRED + "SELECT Action_ID, AccountDisplayName, ObjectName, Target_Domain, Position, "
    "predicted_prob FROM pred WHERE predicted = 1 ORDER BY predicted_prob DESC, Action_ID",
    "event_by_id": BASE_FT + f"SELECT {FT_COLS} FROM ft WHERE Action_ID = 163",
    "top_risk_events": BASE_PRED + f"SELECT {PRED_COLS} FROM pred ORDER BY predicted_prob DESC, Action_ID LIMIT 100",
    "table_counts": BASE_UE + "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN "
    + " AND ".join(f"{c} IS NOT NULL" for c in UE_COLS.split(", "))
    + " THEN 1 ELSE 0 END) AS BIGINT) AS n_complete FROM ue",
    "label_distribution": BASE_FT + "SELECT Risk_Label, CAST(count(*) AS BIGINT) AS n, "
    "CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM ft) AS DOUBLE) AS share FROM ft GROUP BY Risk_Label",
    "next_action_id": BASE_UE + "SELECT CAST(coalesce(max(Action_ID), 0) + 1 AS BIGINT) AS next_action_id FROM ue",
    "scoring_summary": BASE_PRED + """SELECT model_version, CAST(count(*) AS BIGINT) AS n_scored,
  CAST(sum(CASE WHEN predicted = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged,
  CAST(sum(CASE WHEN predicted = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_safe,
  round(avg(predicted_prob), 10) AS avg_prob, max(predicted_prob) AS max_prob
FROM pred GROUP BY model_version""",
    "distinct_domains": BASE_UE + "SELECT DISTINCT Target_Domain FROM ue",
    "high_risk_positions_seen": BASE_FEAT + "SELECT DISTINCT Position FROM feat WHERE is_high_risk_position = 1",
    "position_risk_pairs": BASE_FEAT + "SELECT DISTINCT Position, is_high_risk_position FROM feat",
    "union_event_versions": BASE_UE + f"""SELECT DISTINCT {UE_COLS} FROM (
  SELECT * FROM ue WHERE "Timestamp" < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL
  SELECT * FROM ue WHERE "Timestamp" >= TIMESTAMP '2024-01-15 00:00:00') u""",
    "union_all_versions": BASE_UE + f"""SELECT {UE_COLS} FROM ue WHERE "Timestamp" < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL
  SELECT {UE_COLS} FROM ue WHERE "Timestamp" >= TIMESTAMP '2024-01-15 00:00:00'""",
    "append_dedup": BASE_UE + """SELECT Action_ID, "Timestamp", AccountDisplayName FROM ue""",
    "new_events_anti": BASE_UE + f"""SELECT DISTINCT {UE_COLS} FROM ue
WHERE "Timestamp" >= {MAX_TS} - INTERVAL 48 HOUR
  AND Action_ID NOT IN (SELECT Action_ID FROM ue WHERE "Timestamp" < {MAX_TS} - INTERVAL 24 HOUR)""",
    "new_events_filtered": BASE_UE + f"""SELECT {UE_COLS} FROM ue
WHERE "Timestamp" >= {MAX_TS} - INTERVAL 48 HOUR
  AND Action_ID NOT IN (SELECT Action_ID FROM ue WHERE "Timestamp" < {MAX_TS} - INTERVAL 24 HOUR)""",
    "unscored_events": BASE_PRED + f"""SELECT {FT_COLS} FROM ft
WHERE "Timestamp" >= {MAX_TS} - INTERVAL 72 HOUR
  AND Action_ID NOT IN (SELECT Action_ID FROM pred WHERE "Timestamp" < {MAX_TS} - INTERVAL 24 HOUR)""",
    "auc_roc": BASE_CURVE + """SELECT CASE WHEN max(P) > 0 AND max(N) > 0 THEN
  CAST(sum(CAST(pos AS HUGEINT) * CAST(2 * (N - fp) + neg AS HUGEINT)) AS DOUBLE)
  / (2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS auc_roc FROM curve""",
    "average_precision": BASE_CURVE + """SELECT CASE WHEN max(P) > 0 THEN
  round(sum(CAST(pos AS DOUBLE) * precision) / CAST(max(P) AS DOUBLE), 10) END AS average_precision FROM pts""",
    "pr_curve": BASE_CURVE + "SELECT threshold, tp, fp, precision, recall FROM pts",
    "roc_curve": BASE_CURVE + """SELECT threshold, tp, fp,
  CASE WHEN N > 0 THEN CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
  CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr FROM curve""",
    "best_f1_threshold": BASE_CURVE + """, f AS (
  SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM pts)
SELECT threshold, precision, recall, f1, N - fp AS tn, fp, P - tp AS fn, tp
FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1""",
    "confusion_matrix": BASE_CM + "SELECT tn, fp, fn, tp FROM cm",
    "precision_recall": BASE_CM + """SELECT
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall FROM cm""",
    "classification_report": BASE_CM + """, s AS (
  SELECT
    CASE WHEN tn + fn > 0 THEN CAST(tn AS DOUBLE) / CAST(tn + fn AS DOUBLE) ELSE 0.0 END AS p0,
    CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) ELSE 0.0 END AS r0,
    CAST(tn + fp AS BIGINT) AS s0,
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS p1,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS r1,
    CAST(tp + fn AS BIGINT) AS s1,
    CASE WHEN tn + fp + fn + tp > 0 THEN CAST(tp + tn AS DOUBLE) / CAST(tn + fp + fn + tp AS DOUBLE)
         ELSE 0.0 END AS acc
  FROM cm
), s2 AS (
  SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
            CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1, s0 + s1 AS tot FROM s
)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM s2
UNION ALL SELECT '1', p1, r1, f1, s1 FROM s2
UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, tot FROM s2
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot FROM s2
UNION ALL SELECT 'weighted avg',
  CASE WHEN tot > 0 THEN CAST(p0 * s0 + p1 * s1 AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END,
  CASE WHEN tot > 0 THEN CAST(r0 * s0 + r1 * s1 AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END,
  CASE WHEN tot > 0 THEN CAST(f0 * s0 + f1 * s1 AS DOUBLE) / CAST(tot AS DOUBLE) ELSE 0.0 END, tot FROM s2""",
    "stratified_split": _split_sql(0.0),
    "three_way_split": _split_sql(0.2),
}


def _model_comparison() -> str:
    models = BASE_FT.rstrip() + """, ft_hs AS (
  SELECT *,
    (CASE WHEN is_risky_target_domain = 1 THEN 35 ELSE -10 END)
    + (CASE WHEN file_name_has_sensitive_keyword = 1 THEN 30 ELSE -5 END)
    + (CASE WHEN hour("Timestamp") < 8 OR hour("Timestamp") >= 19 THEN 15 ELSE 0 END)
    + (CASE WHEN is_high_risk_position = 1 THEN 8 ELSE 0 END)
    + (CASE WHEN is_monday_or_friday = 1 THEN 5 ELSE 0 END) AS hs
  FROM ft
), m AS (
  SELECT 'rule' AS model, Action_ID AS id, CAST(Risk_Label AS INTEGER) AS label,
         CAST(hs AS DOUBLE) / 100.0 AS score, CASE WHEN hs > 35 THEN 1 ELSE 0 END AS predicted FROM ft_hs
  UNION ALL
  SELECT 'rule_noisy', Action_ID, CAST(Risk_Label AS INTEGER),
         CAST(hs + (Action_ID * 17) % 23 - 11 AS DOUBLE) / 100.0,
         CASE WHEN hs + (Action_ID * 17) % 23 - 11 > 35 THEN 1 ELSE 0 END FROM ft_hs
), sc AS (
  SELECT model, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM m GROUP BY model, score
), tot AS (SELECT model, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY model
), cv AS (
  SELECT sc.model, pos, neg, P, N,
    sum(pos) OVER (PARTITION BY sc.model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (PARTITION BY sc.model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM sc JOIN tot ON sc.model = tot.model
), rk AS (
  SELECT model,
    CAST(sum(CAST(pos AS HUGEINT) * CAST(2 * (N - fp) + neg AS HUGEINT)) AS DOUBLE)
      / (2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) AS auc,
    round(sum(CAST(pos AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / CAST(max(P) AS DOUBLE), 10) AS ap
  FROM cv GROUP BY model
), cmm AS (
  SELECT model,
    sum(CASE WHEN label = 0 AND predicted = 1 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN label = 1 AND predicted = 0 THEN 1 ELSE 0 END) AS fn,
    sum(CASE WHEN label = 1 AND predicted = 1 THEN 1 ELSE 0 END) AS tp
  FROM m GROUP BY model
), mm AS (
  SELECT rk.model, auc, ap,
    CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS prec,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS rec,
    CAST(fp AS DOUBLE) AS fpd, CAST(fn AS DOUBLE) AS fnd
  FROM rk JOIN cmm ON rk.model = cmm.model
), a AS (SELECT * FROM mm WHERE model = 'rule'), b AS (SELECT * FROM mm WHERE model = 'rule_noisy')
"""
    rows = [("AUC-ROC", "auc", ">"), ("AUC-PR", "ap", ">"), ("Precision (class 1)", "prec", ">"),
            ("Recall (class 1)", "rec", ">"), ("False Positives", "fpd", "<"), ("False Negatives", "fnd", "<")]
    selects = [
        f"SELECT '{name}' AS metric, a.{c} AS model_a, b.{c} AS model_b, "
        f"CASE WHEN b.{c} {op} a.{c} THEN 'rule_noisy' ELSE 'rule' END AS winner FROM a, b"
        for name, c, op in rows
    ]
    return models + "\nUNION ALL\n".join(selects)


ORACLE["model_comparison"] = _model_comparison()

ORACLE["encode_features"] = BASE_FT + """, v AS (
  SELECT Action_ID, ActionType AS a, CASE WHEN Action_ID % 40 = 1 THEN 'x' || (Action_ID % 400) ELSE file_extension END AS e,
    CASE WHEN Action_ID % 50 <> 0 THEN Position ELSE 'missing' END AS p, (Action_ID // 40) % 2 = 0 AS seen FROM ft
), ca AS (SELECT a, row_number() OVER (ORDER BY a) - 1 AS c FROM (SELECT DISTINCT a FROM v WHERE seen)
), ce AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS c FROM (SELECT DISTINCT e FROM v WHERE seen)
), cp AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS c FROM (SELECT DISTINCT p FROM v WHERE seen)
)
SELECT Action_ID, CAST(coalesce(ca.c, -1) AS INTEGER) AS ActionType_code, CAST(coalesce(ce.c, -1) AS INTEGER) AS file_extension_code,
  CAST(coalesce(cp.c, -1) AS INTEGER) AS Position_code FROM v LEFT JOIN ca USING (a) LEFT JOIN ce USING (e) LEFT JOIN cp USING (p)"""
# Properties of model results that hold for every id, whatever the model.
ORACLE["model_roundtrip"] = BASE_FT + "SELECT Action_ID, true AS same FROM ft"
ORACLE["explain_additivity"] = BASE_FT + "SELECT Action_ID, CAST(14 AS BIGINT) AS n_inputs, true AS adds_up FROM ft"
ORACLE["score_new_ids"] = BASE_FT + f"""SELECT Action_ID, "Timestamp", Risk_Label, TIMESTAMP '2024-02-01 00:00:00' AS scored_at,
  'gbt_v1' AS model_version FROM ft WHERE "Timestamp" >= {MAX_TS} - INTERVAL 72 HOUR
  AND Action_ID NOT IN (SELECT Action_ID FROM ft WHERE "Timestamp" < {MAX_TS} - INTERVAL 24 HOUR)"""

ORACLE["ingest_outcomes"] = BASE_UE + """, b AS (
  SELECT Action_ID, CASE WHEN "Timestamp" IS NULL OR Action_ID % 50 = 4 THEN 'no time' WHEN Action_ID % 50 = 3 THEN 'time not readable'
    WHEN Action_ID % 50 = 5 THEN 'no id' ELSE 'appended' END AS outcome FROM ue
)
SELECT outcome, CAST(CASE WHEN outcome = 'appended' THEN count(DISTINCT Action_ID) ELSE 2 * count(*) END AS BIGINT) AS n_rows FROM b GROUP BY outcome
UNION ALL SELECT 'returned', CAST(count(DISTINCT Action_ID) AS BIGINT) FROM b WHERE outcome = 'appended'"""
ORACLE["overwrite_readback"] = BASE_UE + """SELECT Action_ID, "Timestamp", CAST("Timestamp" AS DATE) AS event_date, true AS listed, false AS left_over
FROM ue WHERE Action_ID % 4 <> 0"""
ORACLE["daily_features"] = BASE_FT + f"SELECT {FT_COLS} FROM ft"
ORACLE["approx_unique_domains"] = BASE_FEAT + "SELECT Action_ID, user_unique_domains_7d FROM feat"
ORACLE["ranking_bounds"] = BASE_PRED + """, h AS (
  SELECT least(greatest(floor(score * 16), 0), 15) AS bin, sum((label = 1)::INT) AS pos, sum((label <> 1)::INT) AS neg FROM scored GROUP BY ALL
), c AS (
  SELECT pos, neg, sum(pos) OVER (ORDER BY bin DESC) - pos AS tp0, sum(neg) OVER (ORDER BY bin DESC) AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM h
)
SELECT sum(pos * (N - fp))::DOUBLE / (max(P)::DOUBLE * max(N)::DOUBLE) AS auc_low,
  (sum(pos * (N - fp))::DOUBLE + sum(pos * neg)::DOUBLE) / (max(P)::DOUBLE * max(N)::DOUBLE) AS auc_high,
  round(sum(CASE WHEN fp > 0 THEN greatest(pos - fp::DOUBLE * ln((tp0 + pos + fp)::DOUBLE / (tp0 + fp)::DOUBLE), 0.0) ELSE pos END) / max(P), 10) AS ap_low,
  round(sum(CASE WHEN pos > 0 THEN pos::DOUBLE * (tp0 + pos)::DOUBLE / (tp0 + pos + fp - neg)::DOUBLE ELSE 0.0 END) / max(P), 10) AS ap_high
FROM c"""


def _ordered(column: str) -> str:
    w = f"(PARTITION BY {column} ORDER BY md5('42/' || CAST(Action_ID AS VARCHAR)) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"(coalesce(sum(Risk_Label) OVER {w}, 0) + 0.5::DOUBLE) / (count(*) OVER {w} + 1.0::DOUBLE)"


ORACLE["ordered_statistics"] = BASE_FT + f"SELECT Action_ID, {_ordered('AccountDisplayName')} AS user_code, {_ordered('Position')} AS position_code FROM ft"
ORACLE["target_statistics"] = BASE_FT + """, u AS (
  SELECT AccountDisplayName, (sum(Risk_Label) + 0.5::DOUBLE) / (count(*) + 1.0::DOUBLE) AS c FROM ft WHERE (Action_ID // 100) % 2 = 0 GROUP BY ALL
), p AS (
  SELECT Position, (sum(Risk_Label) + 0.5::DOUBLE) / (count(*) + 1.0::DOUBLE) AS c FROM ft WHERE (Action_ID // 100) % 2 = 0 GROUP BY ALL
)
SELECT Action_ID, coalesce(u.c, 0.5::DOUBLE) AS user_code, coalesce(p.c, 0.5::DOUBLE) AS position_code FROM ft LEFT JOIN u USING (AccountDisplayName) LEFT JOIN p USING (Position)"""
ORACLE["importance_properties"] = """SELECT unnest(['ActionType', 'file_extension', 'Position', 'is_high_risk_extension', 'file_name_has_sensitive_keyword',
  'double_extension_check', 'is_risky_target_domain', 'is_first_time_domain', 'is_after_hours', 'day_of_week', 'is_monday_or_friday',
  'is_high_risk_position', 'user_upload_count_24h', 'user_unique_domains_7d']) AS feature, true AS not_negative, true AS sums_to_one"""


def _split_gains() -> str:
    """Variance of the labels (-1 and 1) before and after each first split."""
    flags = ["is_high_risk_extension", "file_name_has_sensitive_keyword", "double_extension_check", "is_risky_target_domain",
             "is_first_time_domain", "is_after_hours", "is_monday_or_friday", "is_high_risk_position"]
    bounds = {c: [0] for c in flags} | {"day_of_week": [1, 2, 3, 4, 5, 6], "user_upload_count_24h": [1, 2, 3, 5, 10], "user_unique_domains_7d": [1, 2, 3, 4]}
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {b}::DOUBLE AS bound, count(*) FILTER ({c} <= {b}) AS n_left, "
        f"count(*) FILTER ({c} <= {b} AND Risk_Label = 1) AS positives_left, count(*) AS n, count(*) FILTER (Risk_Label = 1) AS p FROM ft WHERE Risk_Label IS NOT NULL"
        for c, bs in bounds.items() for b in bs
    )

    def spread(n: str, p: str) -> str:  # rows x variance of labels -1 and 1
        return f"({n}) * (1.0::DOUBLE - (2.0::DOUBLE * ({p}) / ({n}) - 1.0::DOUBLE) ** 2)"

    gain = f"({spread('n', 'p')} - {spread('n_left', 'positives_left')} - {spread('n - n_left', 'p - positives_left')}) / n"
    return BASE_FT + f""", sides AS ({sides})
SELECT feature, bound, n_left, positives_left, CASE WHEN n_left > 0 AND n_left < n THEN round({gain}, 6) END AS gain FROM sides"""


ORACLE["split_gains"] = _split_gains()
