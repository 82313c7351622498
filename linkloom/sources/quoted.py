"""Records of delimited files with quoted line ends, read by many tasks a file.

Spark splits files at line ends, and whether a line end lies inside quotes depends on all quotes before it.
So the quotes are counted per split first (numbers only), a running sum over a file's splits, one row each,
tells how every split begins, and a second pass puts the lines of each record together, across splits too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "^\ufeff"
_SPLIT = ("file_name", "block")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, block, _at, value); ``_at`` rises within a split, a block is the byte at which it begins."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_at"), "value",
    )


def _numbered(lines: DataFrame, quotes: Column) -> DataFrame:
    """Line numbers and the quotes before each line, both counted from the beginning of the split."""
    place = Window.partitionBy(*_SPLIT).orderBy("_at")
    counted = lines.withColumn("_q", quotes)
    return counted.withColumn("line", F.row_number().over(place)).withColumn("_before", F.sum("_q").over(place) - F.col("_q"))


def _splits(lines: DataFrame, quotes: Column) -> DataFrame:
    """Per split whether it begins inside quotes, and where the record began that is open there."""
    within = _numbered(lines.select(*_SPLIT, "_at", quotes.alias("_n")), F.col("_n"))
    even = F.col("_before") % 2 == 0
    found = within.groupBy(*_SPLIT).agg(
        F.sum("_q").alias("_sum"), F.max(F.when(even, F.col("line"))).alias("_even"), F.max(F.when(~even, F.col("line"))).alias("_odd"),
    )
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("_sum").over(Window.partitionBy("file_name"))
    message = F.concat(F.lit("a quoted field is not closed; read without quoted line ends: "), "file_name")
    opened = F.when(whole % 2 == 0, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2 == 1).otherwise(F.raise_error(message).cast("boolean"))
    last = F.when(F.col("_opened"), F.col("_odd")).otherwise(F.col("_even"))
    start = F.when(last.isNotNull(), F.struct("block", last.alias("line")))
    return found.withColumn("_opened", opened).select(*_SPLIT, "_opened", F.last(start, ignorenulls=True).over(earlier).alias("_carried"))


def _quotes(quote: str) -> Column:
    return F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))


def plain_lines(spark: SparkSession, path: str, quote: str = '"') -> bool:
    """Whether every line is a record: no line's quotes are odd and no CR stands inside one.

    One scan that ends in each split at the first such line; Spark's own line reader gives the same records then.
    """
    odd = (_quotes(quote) % 2 == 1) | F.col("value").rlike("\r[^\r]|\r\r")
    return _lines(spark, path).where(odd).select(F.lit(1)).limit(1).count() == 0


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file_name, block, line, nth, value): one row per record, blank ones left out.

    ``block`` and ``line`` are where a record begins and order a file's records; ``nth`` numbers the records
    that begin in the same split, so a file's first records are 1, 2, ... of block 0.  Line ends are LF or
    CR LF, and those inside quotes stay in the value.  Quotes may stand only around fields (doubled inside
    them); a file whose quotes do not pair is an error.  A compressed file is one split.
    """
    lines = _lines(spark, path)
    quotes = _quotes(quote)
    numbered = _numbered(lines, quotes).join(_splits(lines, quotes), list(_SPLIT))
    place = Window.partitionBy(*_SPLIT).orderBy("line")
    first = (F.col("block") == 0) & (F.col("line") == 1)
    starts = (F.col("_before") % 2 == 1) == F.col("_opened")
    blank = F.col("value").isin("", "\r")
    begin = F.when(starts, F.struct("block", "line"))
    placed = (
        numbered.withColumn("value", F.when(first, F.regexp_replace("value", BYTE_ORDER_MARK, "")).otherwise(F.col("value")))
        .withColumn("_nth", F.sum(F.when(starts & ~blank, 1).otherwise(0)).over(place))
        .withColumn("_begin", F.coalesce(F.last(begin, ignorenulls=True).over(place), "_carried"))
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value", "_nth")))
    joined = F.regexp_replace(F.array_join(F.transform("_l", lambda x: x["value"]), "\n"), "\r\\z", "")
    return (
        placed.groupBy("file_name", "_begin").agg(pieces.alias("_l"))
        .select("file_name", "_begin.block", "_begin.line", F.col("_l")[0]["_nth"].alias("nth"), joined.alias("value"))
        .where(F.col("value") != "")
    )
