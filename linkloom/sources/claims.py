"""Claim texts from the older block-structured grant files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns of the older format.
BLOCK_START = "<PATDOC"
BLOCK = r"(?is)^(.*?</PATDOC>)"
NUMBER = r"(?is)<B110>.*?<DNUM>.*?<PDAT>(.*?)</PDAT>"
CLAIMS = r"(?is)<CL>(.*?)</CL>"
CLAIM = r"(?is)<CLM\b[^>]*>(.*?)</CLM>"
CLAIM_TEXT = r"(?is)<PDAT>(.*?)</PDAT>"
ENTITY = r"&.*?;"


def claims_of(blocks: DataFrame, column: str = "value") -> DataFrame:
    """(patent, claim_no, claim) from texts that start behind the opening of a block.

    Entities are dropped; the text pieces of one claim are joined in order.
    """
    whole = F.regexp_extract(column, BLOCK, 1)
    text = F.regexp_replace(whole, ENTITY, "")
    listed = F.regexp_extract_all(F.regexp_extract(F.col("text"), CLAIMS, 1), F.lit(CLAIM), F.lit(1))
    return (
        blocks.where(F.col(column).rlike(r"(?i)</PATDOC>"))
        .select(text.alias("text"))
        .select(F.regexp_extract("text", NUMBER, 1).alias("patent"), F.posexplode(listed).alias("claim_no", "claim"))
        .select(
            "patent", "claim_no",
            F.array_join(F.regexp_extract_all("claim", F.lit(CLAIM_TEXT), F.lit(1)), "").alias("claim"),
        )
    )


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Claims of every block in the files; the block opening is the record separator."""
    return claims_of(spark.read.option("lineSep", BLOCK_START).text(path))
