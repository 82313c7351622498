"""Ingest in several runs, with repeated documents and a batch that runs twice; cluster files of bounded lines."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from linkloom.sources import delimited, documents
from linkloom.streaming import ingest

PROLOG = '<?xml version="1.0" encoding="UTF-8"?>\n'


def grant(number: str, title: str, inventors: int) -> str:
    people = "".join(f"<inventor><addressbook><first-name>Ann {i}</first-name><last-name>{title}</last-name></addressbook></inventor>" for i in range(inventors))
    return (f'{PROLOG}<!DOCTYPE us-patent-grant SYSTEM "grant.dtd" [ ]>\n<us-patent-grant lang="EN"><us-bibliographic-data-grant><publication-reference><document-id>'
            f"<country>US</country><doc-number>{number}</doc-number><kind>B1</kind><date>20120327</date></document-id></publication-reference>"
            f"<invention-title>{title}</invention-title><inventors>{people}</inventors></us-bibliographic-data-grant></us-patent-grant>\n")


def put(folder, name: str, *texts: str) -> None:
    with open(os.path.join(folder, name), "w") as file:
        file.write("".join(texts))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_later_runs_add_only_what_is_new(spark, tmp_path):
    root, out, state = (str(tmp_path / n) for n in ("files", "tables", "state"))
    os.mkdir(root)
    put(root, "ipg120327.xml", grant("D01", "first", 1), grant("D02", "second", 2), grant("D02", "again", 2))
    ingest.ingest_grants(spark, root, out, state)
    once = {name: rows(ingest.read_ingested(spark, out, name)) for name in ingest.KEYS}
    assert [r[0] for r in once["patent"]] == ["D1", "D2"] and len(once["inventor"]) == 3
    # the same documents under other names, one with a further inventor, one new, one broken
    put(root, "ipg120403.xml", grant("D01", "late", 1), grant("D02", "second", 3), grant("D03", "third", 1), PROLOG + "<!DOCTYPE us-patent-grant>\n<us-patent-grant><a></us-patent-grant>")
    put(root, "ipg120410.xml", grant("D03", "later", 1))
    ingest.ingest_grants(spark, root, out, state)
    titles = dict(ingest.read_ingested(spark, out, "patdesc").select("patent", "title").collect())
    assert titles["D1"] == "FIRST" and titles["D3"] == "THIRD"
    people = rows(ingest.read_ingested(spark, out, "inventor").select("patent", "invseq", "lastname"))
    assert [(p, s) for p, s, _ in people] == [("D1", 0), ("D2", 0), ("D2", 1), ("D2", 2), ("D3", 0)]
    assert set(once["inventor"]) <= set(rows(ingest.read_ingested(spark, out, "inventor")))
    assert ingest.read_ingested(spark, out, "bad_documents").count() == 1
    # a third run finds nothing new
    ingest.ingest_grants(spark, root, out, state)
    assert rows(ingest.read_ingested(spark, out, "inventor").select("patent", "invseq", "lastname")) == people


def test_batches_that_run_again_change_nothing_and_equal_the_batch_job(spark, tmp_path):
    root, out = str(tmp_path / "files"), str(tmp_path / "tables")
    os.mkdir(root)
    put(root, "ipg120327.xml", grant("D01", "first", 2), grant("D02", "second", 1))
    put(root, "ipg120403.xml", grant("D02", "other", 2), grant("D01", "first", 2))
    found = documents.read_documents(spark, root, r"\.xml$")
    halves = [found.where(F.col("file_date") == day) for day in (20120327, 20120403)]
    for batch in (0, 1, 1, 0):
        ingest.shred_batch(halves[batch], out, batch)
    grants = ingest.parsed(found)
    for name in ("inventor", "patent", "patdesc"):
        assert rows(ingest.read_ingested(spark, out, name)) == rows(ingest.first_rows(grants, name))


def test_cluster_lines_are_bounded_and_whole(spark, tmp_path):
    facts = spark.range(1000).select(F.concat(F.lit("m"), F.col("id")).alias("member"), F.when(F.col("id") < 700, "big").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("c"))
    facts = facts.unionByName(spark.createDataFrame([("x", None), (None, "big")], "member string, c string"))
    path = str(tmp_path / "clusters")
    delimited.write_clusters(facts, "c", "member", path, per_line=50)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert max(len(line.split("###")[2].split(",")) for line in lines) == 50
    assert {line.split("###")[1] for line in lines if line.startswith("big###")} == {"700"}
    read = delimited.load_clusters(facts.where("member is not null and c is not null"), "member", delimited.read_clusters(spark, path))
    assert read.where("cluster_id != c or cluster_id is null").count() == 0
    assert {r.cluster_id: r.n for r in read.select("cluster_id", "n").distinct().collect()}["big"] == 700
