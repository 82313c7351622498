"""The operators bound to the test tables: one query each, with SQL where it can express one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings.base import table
from linkloom.llm.chat import MAXIMAL_SQL
from linkloom.llm.collocations import COLLOCATIONS_SQL
from linkloom.llm.store import reachable
from linkloom.operators.normalize import compute_once
from linkloom.session import scratch_path

TOKENIZERS = os.environ.get("LINKLOOM_TOKENIZERS")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.exact_repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=200)


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.token_files import read_ids, write_ids

    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    return read_ids(spark, path, with_ids=False)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                        scratch_path(spark, "token-counts"), limit=1024)


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.quality import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"))


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.warc import read_warc, write_warc

    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    number = r"^<urn:page:(-?\d+)>$"
    found = read_warc(spark, path).where("kind = 'record'")
    return found.select(
        F.regexp_extract("record_id", number, 1).try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", number, 1).try_cast("long").alias("refers_to"))


WARC_SQL = """
WITH r AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT p, max(page_id) AS response FROM r GROUP BY p)
SELECT page_id, CAST(strlen(r.p) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(d, 1 + 10 * (k // 8), 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31) + 1 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM r JOIN g ON r.p = g.p
"""


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.near_duplicates import near_duplicate_components

    return near_duplicate_components(table(spark, sf_dir, "documents"), words=2, percent=80)


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.decontamination import find_contamination

    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.templates import drop_recurring_lines

    cleaned = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def maximal_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.chat import maximal_conversations

    return maximal_conversations(table(spark, sf_dir, "conversations"))


def collocation_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), support=30, longest=4, top=2000, covered=80)


def neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from linkloom.llm.neighbour_quality import score_quality

    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    labels = table(spark, sf_dir, "labels").where(fold != 0)
    scored = score_quality(table(spark, sf_dir, "documents"), labels, neighbours=25, fit_rows=4096)
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the texts, a tenth of which are given a periodic end first; digests of what the operator returns."""
    from linkloom.llm.periodic_runs import periodic_runs

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "text", digest.alias("_h"), F.floor(digest / 10).alias("_g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = compute_once(marked, "_w", F.when(F.col("_h") % 10 == 0, words))
    marked = marked.withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    period = 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))
    marked = marked.withColumn("_p", period.cast("int"))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    repeated = F.array_join(F.transform("_w", lambda w, i: F.get("_w", place(i))), " ")
    found = periodic_runs(marked.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text")), least=6, times=4)
    # length / period as one exact order: the fractions of two runs differ in their cross products
    better = lambda x, y: y["length"] * x["period"] - x["length"] * y["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(better(top, r) > 0, r).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    found = compute_once(found, "_b", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_b.start", "_b.length", "_b.period",
        F.floor(F.col("_b.length") * 1000 / F.col("_b.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return query(spark, sf_dir)

    return run


_BOUND: dict[str, Query] = {
    "op1_exact_repeats": exact_repeats,
    "op2_token_ids": token_ids,
    "op3_quality": quality,
    "op4_warc": warc,
    "op5_near_duplicates": near_duplicates,
    "op6_token_counts": token_counts,
    "op7_contamination": contamination,
    "op8_maximal_chats": maximal_chats,
    "op9_line_templates": line_templates,
    "op10_packing": packing,
    "op11_collocations": collocation_phrases,
    "op12_neighbour_quality": neighbour_quality,
    "op13_word_runs": word_runs,
}

QUERIES: dict[str, Query] = {name: _ready(query) for name, query in _BOUND.items()}

ORACLES: dict[str, str] = {"op4_warc": WARC_SQL, "op8_maximal_chats": MAXIMAL_SQL, "op11_collocations": COLLOCATIONS_SQL}
