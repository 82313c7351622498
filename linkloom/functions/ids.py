"""Document-number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_leading_zero(col: Column) -> Column:
    """Drop one zero after the leading capitals."""
    return F.coalesce(F.regexp_replace(col, "^([A-Z]*)0", "$1"), F.lit(""))


def _parts(col: Column) -> tuple[Column, Column, Column]:
    bare = F.regexp_replace(col, "[^A-Za-z0-9]", "")
    letters = F.regexp_replace(bare, "[^A-Za-z]", "")
    # only a run of letters that stands together can be taken out again
    digits = F.when(letters == "", bare).otherwise(F.replace(bare, letters, F.lit("")))
    return bare, letters, digits


def _number(digits: Column) -> Column:
    trimmed = F.regexp_replace(digits, "^0+", "")
    return F.when(trimmed == "", "0").otherwise(trimmed)


def simple_number(col: Column) -> Column:
    """Letters then digits without punctuation or leading zeros."""
    bare, letters, digits = _parts(col)
    return F.when(digits.rlike("^[0-9]+$"), F.concat(letters, _number(digits))).otherwise(bare)


def padded_number(col: Column, width: int = 8) -> Column:
    """As ``simple_number`` but zero-padded to ``width`` including the letters."""
    bare, letters, digits = _parts(col)
    number = _number(digits)
    size = F.greatest(F.length(number), F.lit(width) - F.length(letters))
    return F.when(digits.rlike("^[0-9]+$"), F.concat(letters, F.lpad(number, size, F.lit("0")))).otherwise(bare)


def national_number(col: Column, country: Column, width: int = 8) -> Column:
    """US numbers padded to ``width``; applications (with a slash) and foreign ones untouched."""
    letters = F.regexp_extract(col, "([A-Z]+)", 1)
    digits = F.regexp_extract(col, "([0-9]+)", 1)
    size = F.greatest(F.length(digits), F.lit(width) - F.length(letters))
    padded = F.concat(letters, F.lpad(digits, size, F.lit("0")))
    keep = (country != "US") | (F.position(F.lit("/"), col) > 1) | (F.length(col) == width)
    return F.when(keep, col).otherwise(padded)


def number_type(col: Column) -> Column:
    """The leading letter, or ``U`` for a plain number."""
    first = F.substring(col, 1, 1)
    return F.when(first.rlike("[0-9]"), "U").otherwise(first)


def class_label(col: Column) -> Column:
    """``mmmsssxxx`` as ``mmm/sss.xxx``."""
    rest = F.substr(col, F.lit(7))
    label = F.concat(F.substring(col, 1, 3), F.lit("/"), F.substring(col, 4, 3))
    return F.when(rest != "", F.concat(label, F.lit("."), rest)).otherwise(label)
