"""Quality of a clustering against hand-checked labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.similarity import jarow
from linkloom.operators.aggregates import modal_value
from linkloom.operators.lookup import differs
from linkloom.session import cut_lineage

MATCH_SCORE = 0.90


def match_truth(
    base: DataFrame, truth: DataFrame, exact: Sequence[str], fuzzy: Sequence[str], cluster: str, truth_id: str
) -> DataFrame:
    """Base rows that agree with a truth row on ``exact`` and resemble it on ``fuzzy``.

    The score is the product of the fuzzy columns' similarities and must exceed 0.90.  Of the
    exact join's rows each distinct pair of texts is scored once, column after column; without fuzzy columns the exact join is all.
    """
    wanted = truth.select(
        *exact, F.col(truth_id).alias("truth_id"), *[F.col(c).alias(f"_t_{c}") for c in fuzzy]
    )
    joined = base.withColumn("cluster_id", F.col(cluster)).join(wanted, list(exact))
    if not fuzzy:
        return joined
    # the score is costly and a pair of texts comes many times, so each distinct pair is scored once; the set number of
    # tasks keeps the small table of pairs from being scored by a few
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = joined.withColumn("score", F.lit(1.0))
    # no factor exceeds 1, so every factor and the product so far must exceed the bound
    for column in fuzzy:
        pair = [column, f"_t_{column}"]
        passing = F.filter(F.array(jarow(*pair)), lambda s: s > MATCH_SCORE)
        scored = joined.select(*pair).distinct().repartition(tasks).withColumn("_factor", F.explode_outer(passing))
        kept = [c for c in joined.columns if c not in ("score", f"_t_{column}")]
        product = (F.col("score") * F.col("_factor")).alias("score")
        joined = joined.join(scored.where(F.col("_factor").isNotNull()), pair).select(*kept, product)
        joined = joined.where(F.col("score") > MATCH_SCORE)
    return joined


def best_matches(matches: DataFrame, exact: Sequence[str]) -> DataFrame:
    """Rows with the highest score per truth id and exact key (ties stay)."""
    if "score" not in matches.columns:
        return matches
    keys = ["truth_id", *exact]
    top = F.max("score").over(Window.partitionBy(*keys))
    return matches.withColumn("_top", top).where(F.col("score") == F.col("_top")).drop("_top")


def expand_clusters(base: DataFrame, best: DataFrame, exact: Sequence[str], cluster: str) -> DataFrame:
    """Every base row of every matched cluster, once per truth id of the cluster.

    ``truth_sub`` holds the truth id of rows that matched themselves.
    """
    owners = best.where(F.col("cluster_id").isNotNull()).select("cluster_id", "truth_id").distinct()
    direct = best.select("cluster_id", *exact, F.col("truth_id").alias("truth_sub"))
    rows = base.withColumn("cluster_id", F.col(cluster)).join(
        owners.select("cluster_id").distinct(), "cluster_id", "left_semi"
    )
    marked = rows.join(direct, ["cluster_id", *exact], "left")
    return marked.join(owners, "cluster_id")


def mark_errors(expanded: DataFrame, year: str | None = None, last_year: str | None = None) -> DataFrame:
    """Flag rows whose cluster is not the most frequent one of their truth id."""
    modal = modal_value(expanded, ["truth_id"], "cluster_id", "main_cluster")
    marked = expanded.join(modal, "truth_id").withColumn(
        "error", differs(F.col("main_cluster"), F.col("cluster_id"))
    )
    if year and last_year is not None:
        marked = marked.where(F.col(year).cast("string") <= last_year)
    return marked


def summarise(marked: DataFrame) -> DataFrame:
    """One row: sizes, over-clump and under-clump shares, precision and recall."""
    counts = marked.agg(
        F.count("truth_sub").alias("original"),
        F.count(F.lit(1)).alias("total"),
        F.count("error").alias("under_clump"),
    )
    under = F.try_divide(F.col("under_clump"), F.col("original"))
    over = 1 - F.try_divide(F.col("original"), F.col("total"))
    recall = 1 - under
    return counts.select(
        "original",
        (F.col("total") - F.col("original")).alias("new_records"),
        "total",
        (F.col("total") - F.col("original")).alias("over_clump"),
        over.alias("over_share"),
        "under_clump",
        under.alias("under_share"),
        F.try_divide(recall, recall + over).alias("precision"),
        recall.alias("recall"),
    )


def verify(
    base: DataFrame, truth: DataFrame, exact: Sequence[str], fuzzy: Sequence[str], cluster: str, truth_id: str,
    year: str | None = None, last_year: str | None = None, columns: Sequence[str] | None = None,
) -> DataFrame:
    """The flagged detail table of a whole verification run.

    ``columns`` are those of the base that the table is to show, all where none are given; the others are not written again.
    """
    best = best_matches(match_truth(base, truth, exact, fuzzy, cluster, truth_id), exact)
    # both are read several times below; of the best matches only what marks the base's rows
    best = cut_lineage(best.select("cluster_id", "truth_id", *exact))
    rows = base if columns is None else base.select(*dict.fromkeys([*exact, cluster, *columns]))
    return mark_errors(cut_lineage(expand_clusters(rows, best, exact, cluster)), year, last_year)


def gold_sample(facts: DataFrame, wanted: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fact rows for the listed keys, reshaped."""
    return facts.join(wanted.select(*keys).distinct(), list(keys), "left_semi").select(*columns)


def gold_presence(gold: DataFrame, facts: DataFrame, doc: str, keys: Sequence[str]) -> DataFrame:
    """Hit flag per gold row; seven-character document ids are read with a leading zero."""
    full = gold.withColumn(
        doc, F.when(F.length(doc) == 7, F.lpad(doc, 8, "0")).otherwise(F.col(doc))
    )
    present = facts.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return full.join(present, list(keys), "left").withColumn("hit", F.coalesce("_hit", F.lit(0))).drop("_hit")
