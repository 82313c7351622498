"""Person-name helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_given(first: Column) -> Column:
    """The first token of a given-name field."""
    return F.when(first.contains(" "), F.substring_index(first, " ", 1)).otherwise(first)


def join_prefix(first: Column, last: Column) -> Column:
    """The rest of the given-name field moved in front of the surname."""
    rest = F.regexp_replace(first, "(?s)^[^ ]* ", "")
    return F.when(
        first.contains(" "), F.when(rest == "", last).otherwise(F.concat(rest, F.lit(" "), last))
    ).otherwise(last)


def person_label(last: Column, first: Column) -> Column:
    return F.concat_ws(", ", last, first)


def padded_id(letter: Column, number: Column, width: int = 12) -> Column:
    """A letter followed by the number in ``width`` digits."""
    return F.concat(letter, F.lpad(number.cast("string"), width, "0"))


def expand_id(short: Column, width: int = 12) -> Column:
    """``H17`` written out to the full padded form; full forms pass."""
    return F.when(
        F.length(short) < width + 1,
        padded_id(F.substring(short, 1, 1), F.substring(short, 2, width).cast("long"), width),
    ).otherwise(short)
