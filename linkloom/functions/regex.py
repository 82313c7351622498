"""Regular-expression chains with ASCII word boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = "[A-Za-z0-9_]"
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


# next to a pattern part that is surely a word character one look suffices
_BEFORE_WORD = re.compile(r"\\b(?=[A-Za-z0-9]|\[A-Z\]|\[0-9\]|\([A-Z])")
_AFTER_WORD = re.compile(r"(?<=[A-Za-z0-9?+})])\\b")


def ascii_bounds(pattern: str) -> str:
    """Spell ``\\b`` out over ASCII word characters (the JVM's own is Unicode-aware)."""
    pattern = _BEFORE_WORD.sub(f"(?<!{_WORD})", pattern)
    pattern = _AFTER_WORD.sub(f"(?!{_WORD})", pattern)
    return pattern.replace(r"\b", _BOUNDARY)


def has(col: Column, pattern: str) -> Column:
    return col.rlike(ascii_bounds(pattern))


def swap(col: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(col, ascii_bounds(pattern), replacement)


def swap_all(col: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) pairs in order."""
    for pattern, replacement in rules:
        col = swap(col, pattern, replacement)
    return col


def strip(col: Column) -> Column:
    """Trim every kind of ASCII white space from both ends."""
    return F.regexp_replace(col, r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
