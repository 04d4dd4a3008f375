"""Dictionary → regular-expression helpers.

Dictionaries are cleaned the same way everywhere: trimmed, lower-cased, blank
entries dropped, duplicates removed. An entry is matched literally: every
regex metacharacter is escaped, so ``a+b`` only matches the text ``a+b``.
"""

from __future__ import annotations

from collections.abc import Iterable

_META = set(".^$*+?()[]{}|\\/-")


def clean_entries(values: Iterable[str | None], lower: bool = True) -> list[str]:
    """Trim, optionally lower-case, drop blanks and duplicates; keep first order."""
    seen: dict[str, None] = {}
    for v in values:
        if v is None:
            continue
        v = v.strip()
        if lower:
            v = v.lower()
        if v:
            seen.setdefault(v, None)
    return list(seen)


def quote_literal(text: str) -> str:
    """Escape regex metacharacters so both Java and RE2 match the text literally."""
    return "".join("\\" + ch if ch in _META else ch for ch in text)


def alternation(values: Iterable[str], lower: bool = True) -> str | None:
    """``a|b|c`` over quoted entries, or None for an empty dictionary."""
    entries = clean_entries(values, lower=lower)
    if not entries:
        return None
    return "|".join(quote_literal(v) for v in entries)
