"""Files that hold many XML documents: listing, splitting and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns of the document archive.
PROLOG = "<?xml version="
FILE_DATE = r"ipg([0-9]{6})"
DOCTYPE_ROOT = r"(?i)<!DOCTYPE\s+([A-Za-z-]+)"
CENTURY_TURN = 69  # two-digit years from here on belong to the 1900s

# (first date, last date or None for open-ended, layout)
DEFAULT_LAYOUTS = ((20050000, 20130108, "v42"), (20130115, None, "v44"))
FALLBACK_LAYOUT = "v42"


def plain_name(path: Column) -> Column:
    """The last part of a path without the ending of a compressed file."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(gz|bz2)$", "")


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Paths and sizes of the files whose name contains a match of ``pattern`` in any case; none is an error.

    Compressed files match under their plain name too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select("path", name.alias("file_name"), "length").where(name.rlike(f"(?i){pattern}") | plain_name(F.col("path")).rlike(f"(?i){pattern}"))
    if found.isEmpty():
        raise FileNotFoundError(f"no file below {root} matches {pattern}")
    return found


def file_date(name: Column) -> Column:
    """``ipgYYMMDD`` as the integer YYYYMMDD, NULL for other names."""
    digits = F.regexp_extract(name, FILE_DATE, 1)
    year = F.try_to_number(F.substring(digits, 1, 2), F.lit("99"))
    century = F.when(year >= CENTURY_TURN, "19").otherwise("20")
    return F.when(digits != "", F.concat(century, digits).cast("int"))


def layout_for(date: Column, layouts: Sequence[tuple[int, int | None, str]] = DEFAULT_LAYOUTS) -> Column:
    """The document layout of a date; the fallback where no range holds it."""
    chosen = F.lit(FALLBACK_LAYOUT)
    for low, high, layout in reversed(layouts):
        inside = date >= low if high is None else date.between(low, high)
        chosen = F.when(inside, F.lit(layout)).otherwise(chosen)
    return chosen


def split_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """Prolog and DOCTYPE removed: (root, body); text before the first prolog is dropped."""
    body = F.regexp_replace(column, r"(?is)\A.*?<!DOCTYPE\s+[^\[>]*(\[.*?\]\s*)?>\s*", "")
    return (
        lines.withColumn("root", F.regexp_extract(column, DOCTYPE_ROOT, 1))
        .where(F.col("root") != "")
        .withColumn("body", body)
    )


def read_documents(spark: SparkSession, root: str, pattern: str = r".*") -> DataFrame:
    """(file_name, file_date, layout, root, body), one row per document; the date may also be a folder's.

    The prolog is the record separator, so large files are split between tasks and no
    file is read whole; a compressed file is one task's, matches under its plain name too, and is best written in bounded pieces.
    """
    name = F.element_at(F.split("file_name", "/"), -1)
    lines = (
        spark.read.option("lineSep", PROLOG).option("recursiveFileLookup", "true").text(root)
        .select("value", F.col("_metadata.file_path").alias("file_name"))
        .where(name.rlike(f"(?i){pattern}") | plain_name(F.col("file_name")).rlike(f"(?i){pattern}"))
    )
    date = file_date(F.col("file_name"))
    return split_documents(lines).select(
        "file_name", date.alias("file_date"), layout_for(date).alias("layout"), "root", "body"
    )
