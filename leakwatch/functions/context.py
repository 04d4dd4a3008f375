"""Destination, role and time features, plus timestamp parsing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leakwatch.functions.patterns import alternation, clean_entries, quote_literal


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def risky_domain_flag(domain: str | Column, domains: Iterable[str], mode: str = "substring") -> Column:
    """1 when the lower-cased domain matches a listed domain.

    ``substring``: any entry occurs anywhere in the domain (so
    ``notquickshare.example`` matches ``quickshare.example``).
    ``suffix``: the domain equals an entry or ends with ``.`` + entry.
    """
    entries = clean_entries(domains)
    if not entries:
        return F.lit(0).cast("int")
    d = F.lower(_col(domain))
    if mode == "substring":
        return _flag(d.rlike(alternation(entries)))
    if mode == "suffix":
        alt = "|".join(quote_literal(e) for e in entries)
        return _flag(d.rlike(rf"(^|\.)({alt})$"))
    raise ValueError(f"unknown domain match mode {mode!r}")


def high_risk_position_flag(position: str | Column, positions: Iterable[str]) -> Column:
    """1 when the lower-cased role contains any listed role name."""
    alt = alternation(positions)
    if alt is None:
        return F.lit(0).cast("int")
    return _flag(F.lower(_col(position)).rlike(alt))


def after_hours_flag(ts: str | Column, from_hour: int = 19, until_hour: int = 5) -> Column:
    """1 when ``hour >= from_hour`` or ``hour <= until_hour`` (05:59:59 counts)."""
    h = F.hour(_col(ts))
    return _flag((h >= from_hour) | (h <= until_hour))


def day_of_week(ts: str | Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_col(ts)).cast("int")


def risky_day_flag(dow: str | Column, days: Iterable[int] = (2, 6)) -> Column:
    """1 when the day number (1 = Sunday) is listed; default Monday and Friday."""
    return _flag(_col(dow).isin(list(days)))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 (floor), as long."""
    return F.unix_timestamp(_col(ts)).cast("long")


ISO_OFFSET_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X")


def parse_timestamp(text: str | Column, patterns: tuple[str, ...] = ISO_OFFSET_PATTERNS) -> Column:
    """Parse ISO text with an offset (``Z``, ``+hh:mm``, ``+hhmm`` or ``+hh``)
    and up to six digits of a second into its UTC wall-clock; the first
    pattern that parses wins.

    Bad or empty text gives null instead of failing the job, so callers can
    route such rows aside.
    """
    # The session zone is pinned to UTC, so the cast keeps the UTC wall-clock.
    parsed = [F.try_to_timestamp(_col(text), F.lit(p)) for p in patterns]
    return F.coalesce(*parsed).cast("timestamp_ntz")
