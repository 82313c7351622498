"""Column normalisation as a table job."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]


def compute_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters and columns refer to without copying its expression.

    As a generator's output it is neither merged into the next projection nor pushed down
    with a filter.
    """
    return df.withColumn(name, F.explode_outer(F.array(column)))


def normalize_columns(
    df: DataFrame, rules: Mapping[str, Rule], suffix: str = "", distinct: bool = False
) -> DataFrame:
    """Rewrite the named columns (or add ``<name><suffix>``).

    With ``distinct`` a rule runs once per distinct value and the result is joined
    back: worth its shuffle for a costly rule over a column with few values.
    """
    if not distinct:
        return df.withColumns({name + suffix: rule(F.col(name)) for name, rule in rules.items()})
    for name, rule in rules.items():
        values = df.select(F.col(name).alias("_raw")).distinct().withColumn("_clean", rule(F.col("_raw")))
        df = df.join(values, F.col(name).eqNullSafe(F.col("_raw")), "left").drop("_raw")
        df = df.withColumn(name + suffix, F.col("_clean")).drop("_clean")
    return df


def normalize_report(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Per column: rows, rows the rule changes, rows it empties."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("column"), F.col(n).alias("raw"), r(F.col(n)).alias("clean"))
                for n, r in rules.items()
            ]
        )
    )
    return (
        df.select(pairs.alias("p"))
        .groupBy(F.col("p.column").alias("column"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("p.raw") != F.col("p.clean")).alias("n_changed"),
            F.count_if((F.col("p.raw") != "") & (F.col("p.clean") == "")).alias("n_emptied"),
        )
    )
