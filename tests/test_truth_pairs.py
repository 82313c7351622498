"""Scoring of a verification run, and what it writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.plans import evaluate


def test_a_pair_of_texts_is_scored_once(spark, monkeypatch):
    base = spark.createDataFrame([(i % 3, i, "ANNA SMITH" if i % 2 else "ANNA SMYTH", "LONDON" if i % 5 else None, i % 4) for i in range(60)], "doc int, line int, name string, city string, cluster int")
    truth = spark.createDataFrame([(7, d, "ANNA SMITH", "LONDON") for d in (0, 1, 2, 2)], "uid int, doc int, name string, city string")
    got = evaluate.match_truth(base, truth, ["doc"], ["name", "city"], "cluster", "uid")
    assert got.columns == ["doc", "line", "name", "city", "cluster", "cluster_id", "truth_id", "score"]
    # rows without a city match nothing; the document that the truth names twice counts twice
    assert sorted(r.line for r in got.collect()) == sorted(i for i in range(60) if i % 5 for _ in range(2 if i % 3 == 2 else 1))
    assert {(r.name, r.score == 1) for r in got.collect()} == {("ANNA SMITH", True), ("ANNA SMYTH", False)}
    calls = spark.sparkContext.accumulator(0)

    def same(a, b):
        calls.add(1)
        return 1.0 if a == b else 0.95

    monkeypatch.setattr(evaluate, "jarow", lambda a, b: F.udf(same, "double")(a, b))
    n = evaluate.match_truth(base, truth, ["doc"], ["name"], "cluster", "uid").count()
    assert n == 80 and calls.value <= 4


def test_a_run_writes_what_it_reads_again(spark, monkeypatch):
    """The best matches are written without the base's other columns, and so is the detail table where not all are wanted."""
    base = spark.createDataFrame([(d, line, "ANNA SMITH", d % 2, 2000 + line) for d in range(6) for line in range(3)], "doc int, line int, name string, cluster int, year int")
    truth = spark.createDataFrame([(d % 3, d, "ANNA SMITH") for d in range(5)], "uid int, doc int, name string")
    written, kept = [], evaluate.cut_lineage
    monkeypatch.setattr(evaluate, "cut_lineage", lambda df: (written.append(set(df.columns)), kept(df))[1])
    whole = evaluate.verify(base, truth, ["doc"], ["name"], "cluster", "uid", "year", "2001")
    few = evaluate.verify(base, truth, ["doc"], ["name"], "cluster", "uid", "year", "2001", ["year"])
    assert written[0] == written[2] == {"cluster_id", "truth_id", "doc"}
    assert {"line", "name"} <= written[1] and not {"line", "name"} & written[3]
    assert set(base.columns) <= set(whole.columns)
    assert evaluate.summarise(whole).collect() == evaluate.summarise(few).collect()
    # per document two lines to 2001, each with the document's three best matches (none for 5), for each of the three owners of cluster 0 or the two of 1
    assert whole.count() == few.count() == 3 * 2 * 3 * 3 + 2 * 2 * 3 * 2 + 2 * 1 * 2


def test_shuffle_files_go_with_the_writing(spark):
    import os

    from linkloom.session import cut_lineage

    def held():
        root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for top in root for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = held()
    rows = cut_lineage(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    assert not held() - before
    assert rows.count() == 100 and rows.agg(F.sum("n")).first()[0] == 5000
