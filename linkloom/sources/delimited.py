"""Delimited text: type inference, spec-headed files, gazetteers and cluster files."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.aggregates import ordered_values
from linkloom.operators.normalize import compute_once
from linkloom.sources.quoted import plain_lines, quoted_records

# Fixed patterns of the type rules.
NUMBER_MARKS = "[-,.]"
DIGITS = "^[0-9]+$"
SPEC_ROWS = 4


def sanitise(names: list[str]) -> list[str]:
    """Header names reduced to word characters, repeats numbered until the name is free."""
    bare = [re.sub(r"[^A-Za-z0-9_]", "", name or "") or f"v{position}" for position, name in enumerate(names)]
    given, used, result = {b.lower() for b in bare}, set(), []
    for clean in bare:
        name, number = clean, 1
        # a numbered name must not be one that the header itself has
        while name.lower() in used or (number > 1 and name.lower() in given):
            number += 1
            name = f"{clean}{number}"
        used.add(name.lower())
        result.append(name)
    return result


def _number_text(c: str) -> Column:
    return F.replace(F.col(c), F.lit(","), F.lit(""))


def inferred_types(df: DataFrame) -> DataFrame:
    """One row of type names per column, from one aggregate over all rows.

    Digits once ``-,.`` are removed make a number; one point in any value makes it REAL,
    more than one makes it text again, as does anything else.  A column is a number only if
    every value can be read as one, so dates and phone numbers stay text.
    """

    def kind(c: str) -> Column:
        bare = F.regexp_replace(F.col(c), NUMBER_MARKS, "")
        points = F.length(F.col(c)) - F.length(F.replace(F.col(c), F.lit("."), F.lit("")))
        numeric = F.bool_and(F.coalesce(bare.rlike(DIGITS) & (points <= 1), F.lit(False)))
        whole = F.bool_and(_number_text(c).try_cast("bigint").isNotNull())
        real = F.bool_and(_number_text(c).try_cast("double").isNotNull())
        return F.when(numeric & (F.max(points) == 0) & whole, "INTEGER").when(numeric & (F.max(points) > 0) & real, "REAL").otherwise("VARCHAR").alias(c)

    return df.agg(*[kind(c) for c in df.columns])


def typed(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Cast text columns to their inferred types; a value that does not fit an override is an error."""
    found = inferred_types(df).first().asDict()
    found.update(overrides or {})
    casts = {"INTEGER": "bigint", "REAL": "double", "VARCHAR": "string"}
    return df.select(
        *[
            (F.col(c) if casts[found[c]] == "string" else _number_text(c).cast(casts[found[c]])).alias(c)
            for c in df.columns
        ]
    )


def _csv_options(sep: str = ",") -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": ""}


def _fields(records: DataFrame, width: int, sep: str = ",") -> DataFrame:
    """The fields of each record as text columns ``_c0`` and on; missing ones are NULL, further ones left out."""
    schema = ", ".join(f"_c{i} STRING" for i in range(width))
    parsed = F.from_csv("value", schema, {**_csv_options(sep), "multiLine": "true"})
    return compute_once(records.select("value"), "_f", parsed).select("_f.*")


def read_delimited(spark: SparkSession, path: str, header: bool = True, sep: str = ",", multi_line: bool = True) -> DataFrame:
    """All columns as text, '' kept apart from NULL, header names sanitised.

    With ``multi_line`` fields may hold quoted line ends and a file is still read by many tasks; a file whose quotes do
    not pair is an error then.  Without it, and where no field holds a line end, every line is a record.
    """
    reader = spark.read.options(**_csv_options(sep))
    multi_line = multi_line and not plain_lines(spark, path)
    df = reader.csv(path, header=header, multiLine=multi_line)
    names = sanitise(df.columns) if header else [f"v{i}" for i in range(len(df.columns))]
    if multi_line:
        records = quoted_records(spark, path)
        if header:
            records = records.where((F.col("block") != 0) | (F.col("nth") > 1))
        df = _fields(records, len(names), sep)
    return df.toDF(*names)


def read_spec_file(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, list[str]]]:
    """A file with four leading rows (names, types, number formats, roles) and data below.

    Only those four rows, known by their place in the file, reach the driver.  Formats such as ``%08d`` pad digit-only
    values; the second result maps each role (UNIQUE, EXACT, FUZZY) to its columns.  Several files have those rows each.
    Rows come in the order of the file.
    """
    # a file's first records begin in its first split; the reader stops after them
    head = spark.read.options(**_csv_options()).csv(path, header=False, multiLine=True).take(SPEC_ROWS)
    names, types, formats, roles = [[v or "" for v in row] for row in head]
    names = sanitise(names)
    data = quoted_records(spark, path).where((F.col("block") != 0) | (F.col("nth") > SPEC_ROWS))
    raw = _fields(data.orderBy("file_name", "block", "line"), len(names))
    columns = []
    for column, name, kind, pattern in zip(raw.columns, names, types, formats):
        value = F.col(column)
        size = re.fullmatch(r"%0?\.?([0-9]+)d", pattern.strip())
        if size:
            bare = F.regexp_replace(value, "^0+(?=[0-9])", "")
            wanted = F.greatest(F.length(bare), F.lit(int(size.group(1))))
            value = F.when(value.rlike(DIGITS), F.lpad(bare, wanted, F.lit("0"))).otherwise(value)
        if kind.upper().startswith("INT"):
            value = value.try_cast("bigint")
        elif kind.upper() in ("REAL", "FLOAT"):
            value = value.try_cast("double")
        columns.append(value.alias(name))
    by_role: dict[str, list[str]] = {"UNIQUE": [], "EXACT": [], "FUZZY": []}
    for name, role in zip(names, roles):
        for known in by_role:
            if role and role.upper()[0] == known[0]:
                by_role[known].append(name)
    return raw.select(*columns), by_role


def read_foreign_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """The tab-separated names file: (cc1, lat, long, full_name_ro, full_name_nd_ro, short_form, sort_name_ro)."""
    df = spark.read.csv(path, sep="\t", header=True)
    return df.select(
        F.col("CC1").alias("cc1"), F.col("LAT").try_cast("double").alias("lat"), F.col("LONG").try_cast("double").alias("long"),
        *[F.coalesce(F.upper(c), F.lit("")).alias(c.lower()) for c in ("FULL_NAME_RO", "FULL_NAME_ND_RO", "SHORT_FORM", "SORT_NAME_RO")],
    )


def read_national_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """The pipe-separated national file: (city, state, lat, long)."""
    df = spark.read.csv(path, sep="|", header=True)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(
        F.col("FEATURE_NAME").alias("city"), F.col("STATE_ALPHA").alias("state"),
        F.col("PRIM_LAT_DEC").try_cast("double").alias("lat"), F.col("PRIM_LONG_DEC").try_cast("double").alias("long"),
    )


def cluster_members(lines: DataFrame, column: str = "value") -> DataFrame:
    """(member, cluster_id, n) from lines ``id###n###id,id,...``; the line's own id is a member too."""
    piece = F.split(column, "###")
    return (
        lines.select(piece.alias("p"))
        .where(F.size("p") >= 3)
        .select(
            F.col("p")[0].alias("cluster_id"), F.trim(F.col("p")[1]).try_cast("bigint").alias("n"),
            F.array_union(F.array(F.col("p")[0]), F.filter(F.split(F.col("p")[2], ","), lambda m: m != "")).alias("members"),
        )
        .select(F.explode("members").alias("member"), "cluster_id", "n")
    )


def write_clusters(rows: DataFrame, cluster: str, member: str, path: str, per_line: int = 1000) -> None:
    """Lines ``id###n###id,id,...`` of at most ``per_line`` members; n is the whole cluster's number of members on each.

    Members are numbered over ranges, so a cluster of any size is cut into lines by many tasks.
    """
    named = rows.select(F.col(cluster).cast("string").alias("_c"), F.col(member).cast("string").alias("_m")).where("_c is not null and _m is not null")
    placed = ordered_values(named, ["_c"], "_m", "_m")
    totals = placed.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    # members first meet in their line, so a large cluster's total joins its lines only
    lines = placed.groupBy("_c", F.floor(F.col("ordinal") / per_line).alias("_line")).agg(F.sort_array(F.collect_list(F.struct("ordinal", "_m"))).alias("_l"))
    text = F.array_join(F.transform("_l", lambda x: x["_m"]), ",")
    lines.join(totals, "_c").select(F.concat_ws("###", "_c", F.col("_n").cast("string"), text).alias("value")).write.text(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(member, cluster_id, n); a cluster may be cut into several lines, each with its whole size."""
    return cluster_members(spark.read.text(path)).distinct()


def load_clusters(facts: DataFrame, key: str, clusters: DataFrame) -> DataFrame:
    """Cluster id and stated size onto facts by member; a member listed twice takes the smallest cluster id.

    The members of a cluster stay a table of their own (``clusters``), as a list on every fact
    would grow with the square of the cluster.
    """
    single = clusters.groupBy(F.col("member").alias("_m")).agg(F.min(F.struct("cluster_id", "n")).alias("_c"))
    return facts.join(single.select("_m", "_c.*"), F.col(key).cast("string") == F.col("_m"), "left").drop("_m")
