"""Schema evolution, sampling and row appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are missing, with the given types and NULL values."""
    return df.withColumns(
        {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    )


def append_rows(table: DataFrame, more: DataFrame, pad: str = "") -> DataFrame:
    """Append rows that may bring new columns; absent text is ``pad``."""
    return table.unionByName(more, allowMissingColumns=True).na.fill(pad)


def sample_rows(df: DataFrame, columns: Sequence[str], key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in random order: a top-n by a seeded hash of ``key``, cut inside every partition first.

    The same rows come out however the table is partitioned.
    """
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in key)))
    return df.select(*columns, mark.alias("_mark")).orderBy("_mark", *columns).limit(n).drop("_mark")
