"""The corpus pipeline: quality rules, line and near de-duplication, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.bound import tokenizer_file
from linkloom.llm.decontamination import without_contamination
from linkloom.llm.near_duplicates import near_duplicate_components
from linkloom.llm.packing import pack_documents
from linkloom.llm.quality import quality_verdicts
from linkloom.llm.store import reachable, written
from linkloom.llm.templates import drop_recurring_lines

#: Columns of ``documents``; further ones are not carried on.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier rule keep.

    A verdict follows from text, language and source, so rows are chosen by these, not by their id.
    """
    parts = [F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary")) for c in ("text", "lang", "source")]
    nulls = [F.col(c).isNull().cast("string") for c in ("text", "lang", "source")]
    marked = docs.select(*COLUMNS, F.unhex(F.md5(F.concat(*parts, *nulls).cast("binary"))).alias("_mark"))
    kept = quality_verdicts(marked, extra=("_mark",)).where("kept").select("_mark").distinct()
    return marked.join(kept, "_mark", "left_semi").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; ``n_chars`` counts what is left."""
    cleaned = drop_recurring_lines(docs)
    count = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", count).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, five words to a shingle and similarity 0.8.

    Each row is a node of its own, whether its id is null, repeated or shared by other texts; the row of the
    least id stays, rows without id come last.
    """
    reachable(spark)
    marked = written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "marked-rows")
    found = near_duplicate_components(marked, words=5, percent=80, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("_late"), "doc_id", "_row")
    kept = found.join(marked.select("_row", "doc_id"), "_row").groupBy("component_id").agg(F.min(order).alias("_m")).select("_m._row")
    return marked.join(kept, "_row", "left_semi").select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    reachable(spark)
    return without_contamination(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents in windows of 1,024."""
    reachable(spark)
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: No SQL for the stages' iterations, signatures and tokenizers; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
