"""Consolidation of the entity tables into one person-by-document fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.dates import normalise_date
from linkloom.functions.ids import strip_leading_zero
from linkloom.functions.text import clean_assignee, clean_name
from linkloom.operators.aggregates import top_values
from linkloom.operators.normalize import normalize_columns
from linkloom.operators.ranking import index_within
from linkloom.operators.upsert import first_per_key

CLASSES_KEPT = 4


def class_ranks(classes: DataFrame, doc: str, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Running number of a document's classes in input order, from 1."""
    return index_within(classes, [doc], [F.col(o) for o in order], name, start=1)


def class_strings(classes: DataFrame, doc: str, main: str, sub: str, seq: str, n: int = CLASSES_KEPT) -> DataFrame:
    """(doc, classes, class_subs): first ``n`` distinct classes and class-subclass pairs.

    A pair that occurs twice counts at its last position.
    """
    pairs = classes.groupBy(doc, main, sub).agg(F.max(seq).alias("_seq"))
    label = F.when(F.col(sub) != "", F.concat_ws("-", F.col(main), F.col(sub))).otherwise(F.col(main))
    mains = top_values(pairs, [doc], F.col(main), "_seq", "classes", n)
    both = top_values(pairs, [doc], label, "_seq", "class_subs", n)
    return mains.join(both, doc)


def fact_table(
    persons: DataFrame,
    documents: DataFrame,
    assignees: DataFrame,
    classes: DataFrame,
    doc: str = "doc",
    seq: str = "seq",
    copies: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per person and document.

    ``copies`` names further columns that repeat one of the result's (new name to old).
    ``persons`` has (doc, seq, person ...); the other tables are reduced to one row per
    document before they are joined, so the row count is that of ``persons``.
    """
    dims = [
        first_per_key(documents, [doc], [doc]),
        first_per_key(assignees, [doc], [doc]),
        classes,
    ]
    fact = persons
    for dim in dims:
        fact = fact.join(dim, doc, "left")
    invnum = F.concat_ws("-", F.col(doc).cast("string"), F.col(seq).cast("string"))
    repeated = {new: F.col(old) for new, old in (copies or {}).items()}
    return fact.withColumns({"invnum": invnum, "invnum_n": invnum, "unique_record_id": invnum, **repeated})


def strip_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key columns without one zero after their leading capitals; the table's other columns stay."""
    return normalize_columns(df, {c: strip_leading_zero for c in columns})


def clean_lawyers(lawyers: DataFrame, columns: Sequence[str] = ("firstname", "lastname", "orgname")) -> DataFrame:
    return normalize_columns(lawyers, {c: clean_name for c in columns})


def clean_assignees(assignees: DataFrame, column: str = "assignee", out: str = "assignee_asc") -> DataFrame:
    return assignees.withColumn(out, F.upper(clean_assignee(F.col(column))))


def clean_inventors(inventors: DataFrame, columns: Sequence[str] = ("firstname", "lastname", "street")) -> DataFrame:
    return normalize_columns(inventors, {c: clean_name for c in columns})


def clean_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return normalize_columns(df, {c: normalise_date for c in columns})
