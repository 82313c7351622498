"""Chat logs: collapse cumulative snapshots, then render the conversations that remain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.ranking import index_within

_CHUNK = 4096


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn; a marker inside a text is broken up, so that it cannot pass for a turn."""
    shown = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), shown, F.lit("\n<|end|>\n"))


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                          text_col: str = "text", segment_turns: int = 256) -> DataFrame:
    """(conv_id, segment, n_turns, text) of the conversations that no longer one starts with.

    Turns are put in order by turn, role and text.  A rolling hash of 128 bits over the places,
    roles and texts gives every turn prefix its mark; a conversation whose whole mark is a proper
    prefix's mark of another is dropped by an anti-join, and of equal conversations the one with
    the smallest id stays.  The rest is rendered in segments of ``segment_turns`` turns, so that
    a very long conversation is never gathered in one row.

    Rows with a null id are one conversation of their own.  Null roles are shown as "unknown" and null
    texts as empty; for the hash null differs from every value.  Repeated rows are turns of
    their own.  An empty table gives no rows, other columns are ignored.
    """
    rows = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"), turns[role_col].alias("role"),
                        turns[text_col].alias("text"))
    rows = rows.withColumn("_key", F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    placed = index_within(rows, ["_key"], order, "_i", start=1)
    mark = [F.xxhash64(F.lit(seed), "_i", F.col("role").isNull(), "role", F.col("text").isNull(), "text") for seed in (1, 2)]
    terms = placed.select("_key", "conv_id", "_i", mark[0].alias("_t1"), mark[1].alias("_t2"),
                          F.floor(F.col("_i") / _CHUNK).alias("_chunk"))

    # rolling marks: within chunks of a conversation, then over the chunks before
    chunks = terms.groupBy("_key", "_chunk").agg(F.bit_xor("_t1").alias("_b1"), F.bit_xor("_t2").alias("_b2"))
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("_key", "_chunk", *(F.coalesce(F.bit_xor(f"_b{k}").over(earlier), F.lit(0).cast("long")).alias(f"_b{k}") for k in (1, 2)))
    inside = Window.partitionBy("_key", "_chunk").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = terms.select("_key", "_chunk", "_i", *(F.bit_xor(f"_t{k}").over(inside).bitwiseXOR(F.col(f"_t{k}")).alias(f"_r{k}") for k in (1, 2)))
    # the mark before turn i is that of the proper prefix of i - 1 turns
    prefixes = (
        rolled.where("_i > 1").join(chunks, ["_key", "_chunk"])
        .select((F.col("_i") - 1).alias("_n"), *(F.col(f"_r{k}").bitwiseXOR(F.col(f"_b{k}")).alias(f"_h{k}") for k in (1, 2)))
        .distinct()
    )
    whole = terms.groupBy("_key", "conv_id").agg(F.count(F.lit(1)).alias("_n"), F.bit_xor("_t1").alias("_h1"), F.bit_xor("_t2").alias("_h2"))
    kept = (
        whole.groupBy("_n", "_h1", "_h2").agg(F.min(F.struct("conv_id", "_key")).alias("_least"))
        .join(prefixes, ["_n", "_h1", "_h2"], "left_anti")
        .select("_least._key")
    )
    segment = F.floor((F.col("_i") - 1) / segment_turns).cast("long")
    return (
        placed.join(kept, "_key", "left_semi")
        .groupBy("_key", segment.alias("segment"))
        .agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"),
             F.sort_array(F.collect_list(F.struct("_i", rendered_turn(F.col("role"), F.col("text")).alias("_shown")))).alias("_turns"))
        .select("conv_id", "segment", "n_turns", F.array_join(F.transform("_turns", lambda t: t["_shown"]), "").alias("text"))
    )


MAXIMAL_SQL = """
WITH p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
           FROM conversations),
q AS (SELECT conv_id, i, md5(string_agg(md5(coalesce('r' || role, 'n')) || md5(coalesce('t' || text, 'n')), '') OVER (PARTITION BY conv_id ORDER BY i)) AS h FROM p),
n AS (SELECT conv_id, max(i) AS n FROM p GROUP BY conv_id),
w AS (SELECT min(q.conv_id) AS conv_id FROM q JOIN n ON q.conv_id IS NOT DISTINCT FROM n.conv_id AND q.i = n.n
      WHERE NOT EXISTS (SELECT 1 FROM q x JOIN n y ON x.conv_id IS NOT DISTINCT FROM y.conv_id WHERE x.i < y.n AND x.h = q.h AND x.i = q.i)
      GROUP BY q.h, q.i)
SELECT p.conv_id, (p.i - 1) // 256 AS segment, count(*) AS n_turns,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '< |') || chr(10) || '<|end|>' || chr(10), '' ORDER BY i) AS text
FROM p JOIN w ON p.conv_id IS NOT DISTINCT FROM w.conv_id
GROUP BY p.conv_id, (p.i - 1) // 256
"""
