"""Incremental ingest of document files into the shredded tables.

Every micro-batch of new files is split and parsed once, and its rows enter each table only where their
key is not there yet, so the first arrival wins as in the batch job.  A batch writes a folder of its
own per table and looks at the folders of earlier batches only: a batch that runs again after a failure
finds what it found before and overwrites what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.upsert import first_per_key
from linkloom.session import cut_lineage
from linkloom.sources import shred
from linkloom.streaming.jobs import document_stream, run_batches

#: What makes a row of a table the same row; no document leaves one of these out.
KEYS = {
    "assignee": ("patent", "asgseq"), "citation": ("patent", "citseq"), "class": ("patent", "class", "subclass"), "inventor": ("patent", "invseq"),
    "patent": ("patent",), "patdesc": ("patent",), "lawyer": ("patent", "lawseq"), "sciref": ("patent", "citseq"), "usreldoc": ("patent", "seq"),
    "ipcr": ("patent", "seq"),
}
#: How documents of one batch come: by file date (undated files last), file, then text.
_ARRIVAL = ("undated", "file_date", "file_name", "mark")


def first_rows(grants: DataFrame, name: str) -> DataFrame:
    """The rows of a table, of each key the one that arrives first; ``grants`` holds the columns of arrival too."""
    # a table carries nothing but the document's number along, so the arrival goes with that
    numbered = grants.withColumn("patent", F.struct("patent", *_ARRIVAL))
    # written once, as the choice of the first row refers to every column's long rules several times
    rows = cut_lineage(shred.TABLES[name](numbered))
    columns = rows.columns
    rows = rows.withColumn("_from", F.col("patent")).withColumn("patent", F.col("_from.patent"))
    rows = rows.select(*columns, *(F.col(f"_from.{c}").alias(f"_{c}") for c in _ARRIVAL))
    return first_per_key(rows, KEYS[name], [f"_{c}" for c in _ARRIVAL]).select(*columns)


def parsed(documents: DataFrame) -> DataFrame:
    """Split documents (file_name, file_date, root, body) as grants with their arrival."""
    marked = documents.select("file_name", "file_date", "root", "body", F.col("file_date").isNull().alias("undated"), F.md5("body").alias("mark"))
    return shred.parse_grants(marked)


def shred_batch(documents: DataFrame, out: str, batch: int) -> None:
    """Enter a batch of split documents into the tables below ``out``."""
    spark = documents.sparkSession
    documents = cut_lineage(documents.select("file_name", "file_date", "root", "body"))
    grants = cut_lineage(parsed(documents))
    for name, keys in KEYS.items():
        path, fresh = f"{out}/{name}", first_rows(grants, name)
        if batch:
            stored = T.StructType([*fresh.schema, T.StructField("batch", T.LongType())])
            known = spark.read.schema(stored).parquet(path).where(F.col("batch") < batch).select(*keys)
            fresh = fresh.join(known, list(keys), "left_anti").select(*fresh.columns)
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    bad = shred.bad_documents(documents).select("file_name", "file_date", "root", "reason")
    bad.write.mode("overwrite").parquet(f"{out}/bad_documents/batch={batch}")


def ingest_grants(spark: SparkSession, root: str, out: str, checkpoint: str, glob: str = "*.xml", files_per_trigger: int = 1000) -> StreamingQuery:
    """Enter all files below ``root`` that earlier runs have not seen, and stop."""
    return run_batches(document_stream(spark, root, glob, files_per_trigger), checkpoint, "append", lambda rows, batch: shred_batch(rows, out, batch))


def read_ingested(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table as all batches left it."""
    return spark.read.parquet(f"{out}/{name}").drop("batch")
