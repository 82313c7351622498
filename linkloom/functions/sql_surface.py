"""The column rules as functions callable from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from linkloom.functions.similarity import jarow_sql, person_similarity_sql

# name -> (parameters, result type, body)
FUNCTIONS = {
    "jarow": ("a STRING, b STRING", "DOUBLE", jarow_sql("a", "b")),
    "inv_comp": ("a STRING, b STRING", "DOUBLE", person_similarity_sql("a", "b")),
    "segment_of": (
        "x STRING, i INT", "STRING",
        "IF(i = -1, x, coalesce(get(split(x, ' *?[,|] *'), i), ''))",
    ),
    "separator_count": ("x STRING", "INT", "regexp_count(x, '[,|]')"),
    "remove_spaces": ("x STRING", "STRING", "replace(x, ' ', '')"),
    "strip_leading_zero": ("x STRING", "STRING", "coalesce(regexp_replace(x, '^([A-Z]*)0', '$1'), '')"),
    "prefix_of": ("x STRING, n INT", "STRING", "left(x, n)"),
    "suffix_of": ("x STRING, n INT", "STRING", "right(x, n)"),
    "title_case": ("x STRING", "STRING", "initcap(x)"),
    "valid_text": ("x BINARY", "STRING", "coalesce(try_validate_utf8(CAST(x AS STRING)), '')"),
    "number_type": ("x STRING", "STRING", "IF(left(x, 1) RLIKE '[0-9]', 'U', left(x, 1))"),
    "class_label": (
        "x STRING", "STRING",
        "concat(left(x, 3), '/', substring(x, 4, 3), IF(substring(x, 7) <> '', concat('.', substring(x, 7)), ''))",
    ),
    "citation_date": ("x STRING", "DATE", "CAST(try_to_timestamp(nullif(regexp_replace(x, '00$', '01'), ''), 'yyyyMMdd') AS DATE)"),
    "mismatch": ("a STRING, b STRING", "INT", "CASE WHEN a <> b THEN 1 END"),
}


def register(spark: SparkSession) -> None:
    """Define the functions as temporary SQL functions; their bodies stay inside the plan."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
