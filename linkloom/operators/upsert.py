"""Keyed inserts: first row wins or last row wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    """One row per key by a partial aggregate, so a hot key shrinks before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    chosen = (F.max_by if latest else F.min_by)(F.struct(*df.columns), F.struct(*order, *rest))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select("_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row per key; ties go to the smallest remaining columns."""
    return _pick(df, keys, order, latest=False)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row per key; ties go to the largest remaining columns."""
    return _pick(df, keys, order, latest=True)


def insert_or_ignore(
    incoming: DataFrame, keys: Sequence[str], order: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """Rows already present stay; of the incoming ones the first per new key enters."""
    fresh = first_per_key(incoming, keys, order)
    if existing is None:
        return fresh
    return existing.unionByName(fresh.join(existing.select(*keys), list(keys), "left_anti"))


def insert_or_replace(
    incoming: DataFrame, keys: Sequence[str], order: Sequence[str], existing: DataFrame | None = None
) -> DataFrame:
    """The last incoming row per key replaces what was present."""
    fresh = last_per_key(incoming, keys, order)
    if existing is None:
        return fresh
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)
