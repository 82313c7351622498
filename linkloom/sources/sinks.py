"""Writers: folded CSV, relational tables and graph exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.text import fold_ascii
from linkloom.operators.upsert import first_per_key

TEXT_TYPE = "TEXT"


def folded(df: DataFrame) -> DataFrame:
    """All text columns folded to ASCII."""
    return df.select(
        *[
            fold_ascii(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Quotes are doubled and empty texts quoted, as ``read_delimited`` expects them."""
    folded(df).write.mode(mode).csv(path, header=True, quote='"', escape='"')


def column_types(df: DataFrame, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """SQL column types: integers, reals and text of any length unless overridden."""
    result = {}
    for f in df.schema:
        if isinstance(f.dataType, T.IntegralType):
            result[f.name] = "BIGINT" if isinstance(f.dataType, T.LongType) else "INTEGER"
        elif isinstance(f.dataType, T.NumericType):
            result[f.name] = "REAL" if not isinstance(f.dataType, T.DoubleType) else "DOUBLE"
        else:
            result[f.name] = TEXT_TYPE
    return {**result, **(overrides or {})}


def write_jdbc(
    df: DataFrame, url: str, table: str, keys: Sequence[str] = (), overrides: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None, mode: str = "append", order: Sequence[str] = (),
) -> None:
    """Write to a relational table; the first row per key by ``order``, then by the other columns, goes out."""
    rows = first_per_key(df, list(keys), list(order)) if keys else df
    types = ", ".join(f"{n} {t}" for n, t in column_types(df, overrides).items())
    rows.write.option("createTableColumnTypes", types).jdbc(url, table, mode=mode, properties=dict(properties or {}))


def write_graph(vertices: DataFrame, edges: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Vertex and edge tables partitioned by window."""
    vertices.write.mode(mode).partitionBy("win").parquet(f"{path}/vertices")
    edges.write.mode(mode).partitionBy("win").parquet(f"{path}/edges")


def _escaped(name: str) -> Column:
    value = F.col(name).cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    # other control characters have no place in XML
    return F.regexp_replace(value, r"[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]", "")


def _attribute(name: str) -> Column:
    value = _escaped(name)
    return F.concat(F.lit(f'<data key="{name}">'), F.coalesce(value, F.lit("")), F.lit("</data>"))


def graphml_lines(vertices: DataFrame, edges: DataFrame, vertex_attributes: Sequence[str], edge_attributes: Sequence[str]) -> DataFrame:
    """(win, section, ord, line): reading a window's lines by section and ord gives its GraphML text."""
    keys = [f'<key id="{n}" for="node" attr.name="{n}"/>' for n in vertex_attributes]
    keys += [f'<key id="{n}" for="edge" attr.name="{n}"/>' for n in edge_attributes]
    opening = "<graphml>" + "".join(keys) + '<graph edgedefault="undirected">'
    windows = vertices.select("win").distinct()
    frame = F.explode(
        F.array(
            F.struct(F.lit(0).alias("section"), F.lit("").alias("ord"), F.lit(opening).alias("line")),
            F.struct(F.lit(3).alias("section"), F.lit("").alias("ord"), F.lit("</graph></graphml>").alias("line")),
        )
    )
    nodes = vertices.select(
        "win", F.lit(1).alias("section"), F.col("person").cast("string").alias("ord"),
        F.concat(F.lit('<node id="'), _escaped("person"), F.lit('">'), *[_attribute(n) for n in vertex_attributes], F.lit("</node>")).alias("line"),
    )
    links = edges.select(
        "win", F.lit(2).alias("section"), F.concat_ws("-", F.col("src").cast("string"), F.col("dst").cast("string")).alias("ord"),
        F.concat(F.lit('<edge source="'), _escaped("src"), F.lit('" target="'), _escaped("dst"), F.lit('">'),
                 *[_attribute(n) for n in edge_attributes], F.lit("</edge>")).alias("line"),
    )
    return windows.withColumn("f", frame).select("win", "f.*").unionByName(nodes).unionByName(links)


def write_graphml(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text below one folder per window; the part files in name order form the document."""
    ranged = lines.repartitionByRange("win", "section", "ord").sortWithinPartitions("win", "section", "ord")
    ranged.select("win", "line").write.mode(mode).partitionBy("win").text(path)


def write_graphml_files(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One whole document per window, the only file in the window's folder.

    A file has one writer, so a window is one task; it passes through Spark's sort, which spills, and is
    written line by line.  Spark's commit puts a file in place when it is complete.
    """
    whole = lines.repartition("win").sortWithinPartitions("win", "section", "ord")
    whole.select("win", "line").write.mode(mode).option("maxRecordsPerFile", 0).partitionBy("win").text(path)
