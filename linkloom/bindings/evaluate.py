"""Verification queries: order lines clustered by supplier or customer, checked against the orders' customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.bindings import duck
from linkloom.bindings.base import table
from linkloom.plans import evaluate
from linkloom.session import cut_lineage

EXACT, FUZZY = ["doc"], ["name"]


def _base(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a damaged customer name and a cluster that is partly wrong."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    name = (
        F.when(F.expr("l_returnflag = 'A'"), F.replace("c_name", F.lit("0"), F.lit("O")))
        .when(F.expr("l_returnflag = 'R'"), F.concat("c_name", F.lit("x")))
        .otherwise(F.col("c_name"))
    )
    cluster = F.when(F.expr("l_linestatus = 'O' AND l_returnflag = 'R'"), -F.col("l_suppkey") - 1).otherwise(F.col("c_custkey"))
    return lines.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"), name.alias("name"), cluster.alias("cluster"),
        F.year("o_orderdate").alias("year"),
    )


def _truth(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return orders.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("doc"), F.col("c_name").alias("name")
    )


def truth_match(spark: SparkSession, d: str) -> DataFrame:
    found = evaluate.match_truth(_base(spark, d), _truth(spark, d), EXACT, FUZZY, "cluster", "uid")
    return evaluate.best_matches(cut_lineage(found), EXACT).withColumn("score", F.round("score", 6))


def truth_match_exact(spark: SparkSession, d: str) -> DataFrame:
    found = evaluate.match_truth(_base(spark, d), _truth(spark, d).drop("name"), EXACT, [], "cluster", "uid")
    return found.groupBy("truth_id").agg(F.count(F.lit(1)).alias("n"))


def _detail(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    return evaluate.verify(cut_lineage(_base(spark, d)), _truth(spark, d), EXACT, FUZZY, "cluster", "uid", "year", "2000", columns)


def truth_expand(spark: SparkSession, d: str) -> DataFrame:
    return _detail(spark, d)


def truth_summary(spark: SparkSession, d: str) -> DataFrame:
    done = evaluate.summarise(_detail(spark, d, ["year"]))
    return done.select(*[F.round(c, 9).alias(c) if c in ("over_share", "under_share", "precision", "recall") else F.col(c) for c in done.columns])


def truth_summary_all_years(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and under-match share without a last year."""
    marked = evaluate.verify(cut_lineage(_base(spark, d)), _truth(spark, d), EXACT, FUZZY, "cluster", "uid", columns=[])
    return evaluate.summarise(marked).select("original", "total", "under_clump", F.round(100 * F.col("under_share"), 6).alias("under_percent"))


def gold_sample(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.gold_sample(_base(spark, d), _truth(spark, d), ["doc", "name"], ["doc", "line", "name"])


def gold_presence(spark: SparkSession, d: str) -> DataFrame:
    """Padded order keys of urgent orders looked up among the returned lines."""
    gold = table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 7, "0").alias("doc"), "o_custkey")
    facts = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.lpad(F.col("l_orderkey").cast("string"), 8, "0").alias("doc"))
    return evaluate.gold_presence(gold, facts, "doc", ["doc"])


QUERIES = {f.__name__: f for f in (truth_match, truth_match_exact, truth_expand, truth_summary, truth_summary_all_years, gold_sample, gold_presence)}

_BASE = """
bas AS MATERIALIZED (SELECT l_orderkey AS doc, l_linenumber AS line, CASE l_returnflag WHEN 'A' THEN replace(c_name, '0', 'O') WHEN 'R' THEN c_name || 'x' ELSE c_name END AS name,
   CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN -l_suppkey - 1 ELSE c_custkey END AS cluster, year(o_orderdate)::INTEGER AS year
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
tru AS MATERIALIZED (SELECT o_custkey AS uid, o_orderkey AS doc, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey)"""
_MATCH = f"""
src AS (SELECT b.name AS a, t.name AS b FROM bas b JOIN tru t ON b.doc = t.doc), {duck.jarow_ctes('jw', 'src')},
mat AS MATERIALIZED (SELECT b.*, b.cluster AS cluster_id, t.uid AS truth_id, j AS score FROM bas b JOIN tru t ON b.doc = t.doc JOIN jw ON jw.a = b.name AND jw.b = t.name WHERE j > 0.90),
bst AS MATERIALIZED (SELECT * FROM mat QUALIFY score = max(score) OVER (PARTITION BY truth_id, doc))"""
_DETAIL = """
own AS (SELECT DISTINCT cluster_id, truth_id FROM bst),
exp AS MATERIALIZED (SELECT b.*, b.cluster AS cluster_id, m.truth_id AS truth_sub, o.truth_id FROM bas b JOIN own o ON o.cluster_id = b.cluster
   LEFT JOIN (SELECT cluster_id, doc, truth_id FROM bst) m ON m.cluster_id = b.cluster AND m.doc = b.doc),
mod AS (SELECT truth_id, arg_max(cluster_id, (n, cluster_id)) AS main_cluster FROM (SELECT truth_id, cluster_id, count(*) AS n FROM exp GROUP BY ALL) GROUP BY 1),
det AS MATERIALIZED (SELECT exp.*, main_cluster, CASE WHEN main_cluster <> cluster_id THEN 1 END AS error FROM exp JOIN mod USING (truth_id) WHERE year::VARCHAR <= '2000')"""

ORACLES = {
    "truth_match": f"WITH {_BASE}, {_MATCH} SELECT * REPLACE (round(score, 6) AS score) FROM bst",
    "truth_match_exact": f"WITH {_BASE} SELECT uid AS truth_id, count(*) AS n FROM bas JOIN tru USING (doc) GROUP BY 1",
    "truth_expand": f"WITH {_BASE}, {_MATCH}, {_DETAIL} SELECT * FROM det",
    "truth_summary": f"""WITH {_BASE}, {_MATCH}, {_DETAIL}, s AS (SELECT count(truth_sub) AS r, count(*) AS t, count(error) AS e FROM det)
        SELECT r AS original, t - r AS new_records, t AS total, t - r AS over_clump, round(1 - r / t::DOUBLE, 9) AS over_share, e AS under_clump, round(e / r::DOUBLE, 9) AS under_share,
        round((1 - e / r::DOUBLE) / ((1 - e / r::DOUBLE) + 1 - r / t::DOUBLE), 9) AS precision, round(1 - e / r::DOUBLE, 9) AS recall FROM s""",
    "truth_summary_all_years": f"""WITH {_BASE}, {_MATCH}, {_DETAIL.replace(" WHERE year::VARCHAR <= '2000'", "")}
        SELECT count(truth_sub) AS original, count(*) AS total, count(error) AS under_clump, round(100 * (count(error) / count(truth_sub)::DOUBLE), 6) AS under_percent FROM det""",
    "gold_sample": f"WITH {_BASE} SELECT doc, line, name FROM bas SEMI JOIN tru USING (doc, name)",
    "gold_presence": """SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS doc, o_custkey, (o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'))::INTEGER AS hit FROM orders""",
}
