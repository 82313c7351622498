"""Document files are written compressed, in pieces, and found under their plain names."""

import os

from pyspark.sql import functions as F

from linkloom.bindings import sources
from linkloom.sources import documents
from linkloom.streaming import jobs


def _files(root):
    return [os.path.join(at, f) for at, _, names in os.walk(root) for f in names if f.startswith("part-")]


def _rows(spark, n):
    text = F.concat(F.lit('<?xml version="1.0"?>\n<!DOCTYPE us-patent-grant SYSTEM "g.dtd" [ ]>\n<us-patent-grant><n>'), F.col("id"), F.lit("</n>" + "<p>words</p>" * 200 + "</us-patent-grant>"))
    return spark.range(n).select(F.expr("timestamp'2012-01-03 00:00:00'").alias("o_orderdate"), text.alias("value"))


def test_documents_are_stored_small_and_read_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "DOCUMENTS_PER_FILE", 30)
    root = str(tmp_path / "d")
    sources.store_documents(_rows(spark, 100), root)
    files = _files(root)
    assert len(files) >= 4 and sum(map(os.path.getsize, files)) < 100 * 2400 / 5
    found = documents.read_documents(spark, root, r"\.txt$").collect()
    assert sorted(int(r.body.split("<n>")[1].split("<")[0]) for r in found) == list(range(100))
    assert documents.list_files(spark, root, r"\.TXT$").count() == len(files)
    out = str(tmp_path / "o")
    jobs.write_available(jobs.document_stream(spark, root, "*.txt", 2).select("file_date", "body"), out, str(tmp_path / "c"))
    assert spark.read.parquet(out).distinct().count() == 100


def test_plain_and_compressed_files_stand_together(spark, tmp_path):
    root = str(tmp_path / "d")
    sources.store_documents(_rows(spark, 5), root)
    _rows(spark, 3).select("value").coalesce(1).write.text(root + "/plain")
    assert documents.read_documents(spark, root, r"\.txt$").count() == 8
    assert documents.read_documents(spark, root, r"\.gz$").count() == 5
    assert documents.list_files(spark, root, r"\.txt$").count() == len(_files(root))
