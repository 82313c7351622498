"""Equi joins on keys that may be very hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 20_000


def _with_chunks(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], own: str, other: str, own_chunks: str, other_chunks: str, row_key: Column
) -> DataFrame:
    """Own chunk by hash, copied once per chunk of the other side (1 for ordinary keys)."""
    chunks = {c: F.coalesce(F.col(c), F.lit(1).cast("long")) for c in (own_chunks, other_chunks)}
    return (
        df.join(hot, list(keys), "left")
        .withColumn(own, F.pmod(F.xxhash64(row_key), chunks[own_chunks]))
        .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), chunks[other_chunks] - 1)))
        .drop("_gl", "_gr")
    )


def chunked_sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_row: Column, right_row: Column, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells (``_ci``, ``_cj``) in which rows of a key meet.

    A side with n rows of a key has ceil(n / hot_rows) chunks of it; a row is copied once per
    chunk of the other side, so a key that is hot on one side only copies just the other's rows.
    """
    none = F.lit(0).cast("long")
    count = F.count(F.lit(1))
    counted = (
        left.groupBy(*keys).agg(count.alias("_nl")).withColumn("_nr", none)
        .unionByName(right.groupBy(*keys).agg(count.alias("_nr")).withColumn("_nl", none))
        .groupBy(*keys).agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr"))
    )
    chunks = [F.greatest(F.ceil(F.col(n) / F.lit(hot_rows)), F.lit(1)).cast("long").alias(g) for n, g in (("_nl", "_gl"), ("_nr", "_gr"))]
    hot = counted.where(F.greatest("_nl", "_nr") > hot_rows).select(*keys, *chunks)
    return (
        _with_chunks(left, hot, keys, "_ci", "_cj", "_gl", "_gr", left_row),
        _with_chunks(right, hot, keys, "_cj", "_ci", "_gr", "_gl", right_row),
    )


def chunked_equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column,
    left_row: Column,
    right_row: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner equi join whose hot keys are cut into chunk-by-chunk cells.

    A task compares at most hot_rows x hot_rows pairs of one key, and each pair meets in exactly
    one cell.  Right columns other than the keys must differ from left ones.
    """
    cells_left, cells_right = chunked_sides(left, right, keys, left_row, right_row, hot_rows)
    joined = cells_left.alias("l").join(
        cells_right.alias("r"),
        [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*keys, "_ci", "_cj")] + [condition],
    )
    keep_left = [F.col(f"l.{c}") for c in left.columns]
    keep_right = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return joined.select(*keep_left, *keep_right)
