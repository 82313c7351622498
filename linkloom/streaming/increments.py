"""Stream aggregates without streaming state: a batch writes what it adds, and reading merges.

Counts add up, and the earliest of earliest rows is the earliest, so a batch needs nothing of the batches
before it.  No state is kept, no watermark drops a row, and a row counts however late it comes.  A batch
that runs again after a failure overwrites its own folder.  ``compact`` merges finished batches into one
base, so what is read is bounded by the number of keys and the batches since then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.streaming.jobs import run_batches


@dataclass(frozen=True)
class Increments:
    """``part`` makes increments of a batch's rows; ``merge`` makes one row per key of increments, and of its own results again."""

    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def counts(keys: Sequence[str], time: str, width: str) -> Increments:
    """(window_start, keys, n); rows without a time are in no window."""

    def part(rows: DataFrame) -> DataFrame:
        return (
            rows.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), *keys, "n")
        )

    return Increments(part, lambda rows: rows.groupBy("window_start", *keys).agg(F.sum("n").alias("n")))


def word_counts(text: str, time: str, width: str) -> Increments:
    """(window_start, word, n) over the words of a text column."""
    plain = counts(["word"], time, width)
    return Increments(lambda rows: plain.part(rows.select(time, F.explode(F.split(text, " ")).alias("word"))), plain.merge)


def first_seen(keys: Sequence[str], time: str) -> Increments:
    """The earliest row per key, ties by the other columns."""

    def merge(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != time]
        return rows.groupBy(*keys).agg(F.min(F.struct(time, *rest)).alias("_row")).select(*keys, "_row.*")

    return Increments(merge, merge)


def write(stream: DataFrame, kind: Increments, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; increments go below ``path``/parts, one folder a batch."""
    spark = stream.sparkSession
    # an empty batch -1 states the columns, a mark of -1 that no batch is in a base yet
    nothing = kind.part(spark.createDataFrame([], stream.schema))
    nothing.write.mode("ignore").parquet(f"{path}/parts/batch=-1")
    spark.range(1).select(F.lit(-1).cast("long").alias("upto")).write.mode("ignore").parquet(f"{path}/marks")
    return run_batches(stream, checkpoint, "append", lambda rows, batch: kind.part(rows).write.mode("overwrite").parquet(f"{path}/parts/batch={batch}"))


def _covered(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/marks").agg(F.max("upto")).first()[0]


def _increments(spark: SparkSession, path: str, base: int, last: int | None = None) -> DataFrame:
    """Rows of the base and of the batches after it, up to batch ``last``."""
    batch = F.col("batch")
    rows = spark.read.parquet(f"{path}/parts").where(batch > base)
    rows = (rows if last is None else rows.where(batch <= last)).drop("batch")
    return rows if base < 0 else rows.unionByName(spark.read.parquet(f"{path}/base/{base}"))


def read(spark: SparkSession, kind: Increments, path: str) -> DataFrame:
    """The result over all batches so far."""
    return kind.merge(_increments(spark, path, _covered(spark, path)))


def compact(spark: SparkSession, kind: Increments, path: str) -> int:
    """Merge all batches but the last into a base and return the last batch in it (-1: none).

    A batch starts when the one before is committed, so only the last may run again.  A base counts
    once its mark is written, so a compaction that was cut short changes nothing; run one at a time.
    """
    base = _covered(spark, path)
    last = spark.read.parquet(f"{path}/parts").agg(F.max("batch")).first()[0]
    upto = -1 if last is None else last - 1
    if upto <= base:
        return base
    kind.merge(_increments(spark, path, base, upto)).write.mode("overwrite").parquet(f"{path}/base/{upto}")
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{path}/marks")
    return upto
