"""What the organisation jobs write and pass on, counted."""

from pyspark.sql import functions as F

from linkloom.plans import orgs
from linkloom.session import cut_lineage


def _features(spark, names):
    table = cut_lineage(orgs.name_table(spark.createDataFrame([(n, None) for n in names], "name string, asg long"), "name", "asg"))
    words = cut_lineage(orgs.word_table(table))
    return cut_lineage(orgs.name_features(table, words, orgs.frequent_words(words)))


def test_names_alone_in_their_blocks_are_not_written_again(spark):
    alone = [f"{chr(65 + i % 26)}{chr(65 + i // 26)} SINGULAR{i:04d}" for i in range(100)]
    features = _features(spark, [*alone, "ACME WIDGETS", "ACMEWIDGETS", "BETA TOOLS"])
    kept = orgs.block_rows(features)
    assert {(r["pass"], r["block"], r["name"]) for r in kept.collect()} == {(3, "ACMEWIDGETS", "ACME WIDGETS"), (3, "ACMEWIDGETS", "ACMEWIDGETS")}
    assert [r["pass"] for r in orgs.match_edges(features).where("pass > 1").collect()] == [3]


def test_names_travel_under_their_number(spark):
    """The words of a name are gathered by its number: no shuffle of single words holds the name."""
    table = cut_lineage(orgs.name_table(spark.createDataFrame([("ONE TWO", None), ("TWO THREE", None)], "name string, asg long"), "name", "asg"))
    words = cut_lineage(orgs.word_table(table))
    found = orgs.name_features(table, words, words.where("false").select("word", F.col("count").alias("freq")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [place" in plan and "Aggregate [name" not in plan
    assert {r["name"]: (r["name2"], r["freq_s"]) for r in found.collect()} == {"ONE TWO": ("ONE TWO", "1 2"), "TWO THREE": ("TWO THREE", "2 1")}
