"""Numbering rows without sending a table, or a hot group, through one task.

Rows are range-partitioned in the wanted order and written once; every partition
numbers its own rows, and the partition offsets (one row per partition, or per
partition and key) are added back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import cut_lineage

_LOCAL_BITS = 33


def _numbered_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return (
        cut_lineage(ranged)
        .withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )


def global_index(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Number all rows 'start, start+1, ...' in ``order`` (which should be total)."""
    ranged = _numbered_ranges(df, order)
    # one row per range partition, so the broadcast is bounded by the partition count
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_at") + F.lit(start).cast("long"))
        .drop("_part", "_at", "_offset")
    )


def index_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, start: int = 0
) -> DataFrame:
    """Number the rows of each key in ``order``; a hot key is spread over its ranges."""
    ranged = _numbered_ranges(df, [*[F.col(k) for k in keys], *order])
    pieces = ranged.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_part", *keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    return (
        ranged.join(offsets, ["_part", *keys])
        .withColumn(name, F.col("_offset") + F.col("_at") + F.lit(start).cast("long"))
        .drop("_part", "_at", "_offset")
    )


def value_index(df: DataFrame, column: Column, name: str, start: int = 0) -> DataFrame:
    """Number the rows so that equal values share a number (dense, in value order)."""
    keyed = df.withColumn("_value", column)
    numbered = global_index(keyed.select("_value").distinct(), [F.col("_value")], name, start)
    return keyed.join(numbered, "_value").drop("_value")


def top_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "_rank") -> DataFrame:
    """The first ``n`` rows per key; Spark cuts each partition to ``n`` before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
