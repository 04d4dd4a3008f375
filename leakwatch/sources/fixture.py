"""Upload events derived from the driver's generic ``events`` table.

The test data has no upload log, so ``upload_events`` projects ``events``
(event_id, ts, user_id, event_type) onto the upload schema with fixed
rules: the file name, domain and role come from small lists indexed by the
ids, and the label is the rule score plus a deterministic id-based noise
term. The projection is pure column arithmetic (no join, no shuffle), so it
streams straight out of the Parquet scan with pruned columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.config import RiskRules
from leakwatch.functions.context import high_risk_position_flag, risky_day_flag, day_of_week, risky_domain_flag
from leakwatch.functions.files import base_name, keyword_flag
from leakwatch.functions.rules import rule_score_hundredths

# ---------------------------------------------------------------------------
# Fixed values of the test fixture (our own invented lists; index from 0).
# File stems by event_id % 12:
#   client_list, lunch_menu, payroll_run, classnotes, team_photo, budget.CSV,
#   report.pdf, v1.pyramid, meeting_notes, api_token, Statement_May, README
# File suffixes by event_id % 7: .csv, .pdf, .XLSX, .zip, .docx, (empty), .png
# Domains by (event_id * 7 + user_id) % 13:
#   mail.corp.example, wiki.corp.example, crm.corp.example, hr.corp.example,
#   files.corp.example, share.partner.example, drop.files.example,
#   quickshare.example, notquickshare.example, chat.social.example,
#   vendor.example, mirror.partner.example, DROP.Files.Example
# Roles by user_id % 6: Analyst, Branch Teller, Credit Officer,
#   Senior Credit Officer, Data Engineer, Portfolio Manager
# No file name when event_id % 97 = 0.
# Label noise: (event_id * 31) % 41 - 20, added to the rule score.
# Dictionaries: risky domains drop.files.example, quickshare.example,
#   social.example; keywords client, payroll, token, statement, ssn;
#   high-risk roles credit officer, portfolio manager; high-risk extensions
#   csv, pdf, xlsx, docx; double-extension list pdf, csv, py, zip.
# ---------------------------------------------------------------------------
STEMS = (
    "client_list", "lunch_menu", "payroll_run", "classnotes", "team_photo", "budget.CSV",
    "report.pdf", "v1.pyramid", "meeting_notes", "api_token", "Statement_May", "README",
)
SUFFIXES = (".csv", ".pdf", ".XLSX", ".zip", ".docx", "", ".png")
DOMAINS = (
    "mail.corp.example", "wiki.corp.example", "crm.corp.example", "hr.corp.example",
    "files.corp.example", "share.partner.example", "drop.files.example", "quickshare.example",
    "notquickshare.example", "chat.social.example", "vendor.example", "mirror.partner.example",
    "DROP.Files.Example",
)
POSITIONS = (
    "Analyst", "Branch Teller", "Credit Officer", "Senior Credit Officer", "Data Engineer",
    "Portfolio Manager",
)
NULL_NAME_EVERY = 97
FIXTURE_RISKY_DOMAINS = ("drop.files.example", "quickshare.example", "social.example")
FIXTURE_KEYWORDS = ("client", "payroll", "token", "statement", "ssn")
FIXTURE_POSITIONS = ("credit officer", "portfolio manager")
FIXTURE_HIGH_RISK_EXTENSIONS = ("csv", "pdf", "xlsx", "docx")
FIXTURE_DOUBLE_EXTENSIONS = ("pdf", "csv", "py", "zip")


def fixture_rules(**overrides) -> RiskRules:
    """Rules used with the fixture events (the dictionaries above)."""
    params = dict(
        risky_domains=FIXTURE_RISKY_DOMAINS,
        sensitive_keywords=FIXTURE_KEYWORDS,
        high_risk_positions=FIXTURE_POSITIONS,
        high_risk_extensions=FIXTURE_HIGH_RISK_EXTENSIONS,
        double_extensions=FIXTURE_DOUBLE_EXTENSIONS,
    )
    params.update(overrides)
    return RiskRules(**params)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    # Constant array + element_at: folded once, evaluated in generated code.
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def upload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upload-event table over ``{sf_dir}/events.parquet``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    return project_events(ev)


def project_events(ev: DataFrame) -> DataFrame:
    """Map (event_id, ts, user_id, event_type) rows onto the upload schema."""
    eid, uid = F.col("event_id"), F.col("user_id")
    name = F.when(F.pmod(eid, F.lit(NULL_NAME_EVERY)) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(_pick(STEMS, F.pmod(eid, F.lit(len(STEMS)))), _pick(SUFFIXES, F.pmod(eid, F.lit(len(SUFFIXES)))))
    )
    domain = _pick(DOMAINS, F.pmod(eid * 7 + uid, F.lit(len(DOMAINS))))
    position = _pick(POSITIONS, F.pmod(uid, F.lit(len(POSITIONS))))
    base = ev.select(
        eid.cast("long").alias(S.ID),
        F.col("ts").cast("timestamp_ntz").alias(S.TS),
        F.col("event_type").alias(S.ACTION),
        name.alias(S.OBJECT),
        domain.alias(S.DOMAIN),
        F.concat(F.lit("User_"), uid.cast("string")).alias(S.USER),
        position.alias(S.POSITION),
    )
    score = rule_score_hundredths(
        risky_domain_flag(S.DOMAIN, FIXTURE_RISKY_DOMAINS),
        keyword_flag(base_name(S.OBJECT), FIXTURE_KEYWORDS),
        S.TS,
        high_risk_position_flag(S.POSITION, FIXTURE_POSITIONS),
        risky_day_flag(day_of_week(S.TS)),
    )
    noise = F.pmod(F.col(S.ID) * 31, F.lit(41)) - 20
    label = F.when(score + noise > 35, 1).otherwise(0).cast("long")
    return base.withColumn(S.LABEL, label)
