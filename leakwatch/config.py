"""Rule parameters of the feature build.

Everything the feature rules compare against is a parameter here, so a
deployment can change role names, extension lists or window lengths without
touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's for equal results.
#
# Extensions searched for inside a base name (double-extension check):
#   pdf, docx, xlsx, doc, xls, ppt, pptx, csv, zip, 7z, rar, py, sh, bat, ps1, sql, txt
# Extensions counted as high risk:
#   pdf, csv, xlsx, xls, docx, doc, sql, txt, json
# Job roles counted as high risk:
#   Relationship Banker, System Architect, Loan Officer, Wealth Manager
# After-hours: hour >= 19 or hour <= 5.  Monday/Friday: dayofweek in (2, 6).
# Rolling windows: 86400 s (24 h) for the upload count, 604800 s (7 d) for
# distinct domains, both ends inclusive.
# Rule score weights in hundredths: risky domain +35 else -10, sensitive
# keyword +30 else -5, hour < 8 or >= 19 +15, high-risk role +8,
# Monday/Friday +5; label when the score is above 35.
# ---------------------------------------------------------------------------
DEFAULT_DOUBLE_EXTENSIONS = (
    "pdf", "docx", "xlsx", "doc", "xls", "ppt", "pptx", "csv", "zip",
    "7z", "rar", "py", "sh", "bat", "ps1", "sql", "txt",
)
DEFAULT_HIGH_RISK_EXTENSIONS = ("pdf", "csv", "xlsx", "xls", "docx", "doc", "sql", "txt", "json")
DEFAULT_HIGH_RISK_POSITIONS = ("Relationship Banker", "System Architect", "Loan Officer", "Wealth Manager")
SECONDS_24H = 86400
SECONDS_7D = 7 * 86400


@dataclass(frozen=True)
class RuleWeights:
    """Rule score weights in integer hundredths (exact, no float ties)."""

    risky_domain: int = 35
    safe_domain: int = -10
    sensitive_file: int = 30
    plain_file: int = -5
    off_hours: int = 15
    high_risk_role: int = 8
    monday_friday: int = 5
    threshold: int = 35
    off_hours_before: int = 8
    off_hours_from: int = 19


@dataclass(frozen=True)
class RiskRules:
    """All dictionaries and bounds used by the feature rules."""

    risky_domains: tuple[str, ...] = ()
    sensitive_keywords: tuple[str, ...] = ()
    high_risk_positions: tuple[str, ...] = DEFAULT_HIGH_RISK_POSITIONS
    high_risk_extensions: tuple[str, ...] = DEFAULT_HIGH_RISK_EXTENSIONS
    double_extensions: tuple[str, ...] = DEFAULT_DOUBLE_EXTENSIONS
    # Double extension: False = unanchored, case-sensitive search of ".ext"
    # in the base name; True = case-insensitive, ".ext" followed by "." or end.
    strict_double_extension: bool = False
    # "substring": unanchored match of any entry; "suffix": the domain equals
    # an entry or ends with "." + entry.
    domain_match: str = "substring"
    after_hours_from: int = 19
    after_hours_until: int = 5
    risky_days: tuple[int, ...] = (2, 6)
    count_window_seconds: int = SECONDS_24H
    distinct_window_seconds: int = SECONDS_7D
    weights: RuleWeights = field(default_factory=RuleWeights)
