"""File-name features: extension, base name, double extension, risk flags.

All are built-in column expressions (codegen'd, no Python at run time).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leakwatch.functions.patterns import alternation, clean_entries


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_extension(name: str | Column) -> Column:
    """Text after the last dot, lower-cased; the whole name when there is no dot.

    ``"file."`` gives ``""``, ``".bashrc"`` gives ``"bashrc"``, null stays null.
    """
    return F.lower(F.substring_index(_col(name), ".", -1))


def base_name(name: str | Column) -> Column:
    """Name without its last ``.ext`` (one or more non-dot characters at the end).

    ``"file."`` stays ``"file."``; ``".bashrc"`` becomes ``""``.
    """
    return F.regexp_replace(_col(name), r"\.[^.]+$", "")


def _flag(cond: Column) -> Column:
    # A null condition falls to 0, so flags are never null.
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def double_extension_flag(
    base: str | Column, extensions: Iterable[str], strict: bool = False
) -> Column:
    """1 when the base name still holds ``.ext`` for a listed extension.

    Default: unanchored and case-sensitive (``x.pyramid.txt`` → 1 through
    ``.py``; ``Data.CSV.zip`` → 0). ``strict=True``: case-insensitive and the
    extension must end at a dot or at the end of the base name.
    """
    alt = alternation(extensions, lower=not strict)
    if alt is None:
        return F.lit(0).cast("int")
    if strict:
        return _flag(F.lower(_col(base)).rlike(rf"\.({alt})(\.|$)"))
    return _flag(_col(base).rlike(rf"\.({alt})"))


def high_risk_extension_flag(extension: str | Column, extensions: Iterable[str]) -> Column:
    """1 when the (lower-cased) extension equals a listed one."""
    entries = clean_entries(extensions)
    if not entries:
        return F.lit(0).cast("int")
    return _flag(_col(extension).isin(entries))


def keyword_flag(base: str | Column, keywords: Iterable[str]) -> Column:
    """1 when the lower-cased base name contains any keyword (literal substring)."""
    alt = alternation(keywords)
    if alt is None:
        return F.lit(0).cast("int")
    return _flag(F.lower(_col(base)).rlike(alt))
