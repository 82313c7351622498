"""Aggregates over groups of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ranking import index_within, top_within


def top_values(
    df: DataFrame, keys: Sequence[str], value: Column, order: str, name: str, n: int = 4, sep: str = "/"
) -> DataFrame:
    """Per key the first ``n`` distinct values by ``order``, joined with ``sep``.

    The value list of a group is never gathered: repeats fold to their first
    position, then only ``n`` rows per key are kept.
    """
    firsts = (
        df.withColumn("_value", value)
        .groupBy(*keys, "_value")
        .agg(F.min(order).alias("_order"))
    )
    kept = top_within(firsts, keys, [F.col("_order"), F.col("_value")], n)
    return kept.groupBy(*keys).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_rank", "_value"))), lambda x: x["_value"]
            ),
            sep,
        ).alias(name)
    )


def modal_value(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent value per key; ties go to the largest value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", value)).alias(name))


def ordered_values(df: DataFrame, keys: Sequence[str], value: str, name: str, distinct: bool = False) -> DataFrame:
    """(keys, ordinal, value) rows: the values of each key in order, numbered from 0.

    Every key has this one shape whatever its size; numbering runs over ranges, so a hot key is
    spread over tasks.  ``joined_values`` makes one text of them at a sink.
    """
    items = df.select(*keys, F.col(value).alias(name))
    items = items.distinct() if distinct else items
    return index_within(items, list(keys), [F.col(name)], "ordinal").select(*keys, "ordinal", name)


def joined_values(df: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = ",") -> DataFrame:
    """One row per key: its values in order as one text, and their number; for file formats that ask for it."""
    items = F.sort_array(F.collect_list(F.col(value)))
    return df.groupBy(*keys).agg(F.array_join(items.cast("array<string>"), sep).alias(name), F.count(value).alias("n_values"))


def unique_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """(keys, ordinal, value) rows of the distinct upper-cased values per key; '' for a single one."""
    upper = df.select(*keys, F.upper(value).alias("_v"))
    rows = ordered_values(upper, keys, "_v", name, distinct=True)
    totals = rows.groupBy(*keys).agg(F.max("ordinal").alias("_last"))
    return rows.join(totals, list(keys)).select(*keys, "ordinal", F.when(F.col("_last") == 0, "").otherwise(F.col(name)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency table, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def counts_per_document(
    documents: DataFrame, key: str, measures: Mapping[str, tuple[DataFrame, str, Column]]
) -> DataFrame:
    """Attach counts from child tables, 0 where a document has no child row.

    ``measures`` maps an output name to (child table, its document column, aggregate).
    Each child is reduced to one row per document before it is joined.
    """
    result = documents
    for name, (child, child_key, measure) in measures.items():
        reduced = child.groupBy(F.col(child_key).alias("_doc")).agg(measure.alias(name))
        result = (
            result.join(reduced, F.col(key) == F.col("_doc"), "left")
            .drop("_doc")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)))
        )
    return result


def spread_limit(df: DataFrame, column: str, name: str = "cutoff", deviations: float = 3.0) -> DataFrame:
    """One row: mean plus ``deviations`` population standard deviations."""
    return df.agg((F.avg(column) + F.stddev_pop(column) * F.lit(deviations)).alias(name))
