"""Readers and writers on small files."""

from pyspark.sql import functions as F

from linkloom.sources import claims, delimited, documents, shred, sinks

GRANT = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE us-patent-grant SYSTEM "x.dtd" [ <!ENTITY a SYSTEM "a.tif"> ]>
<us-patent-grant lang="EN"><us-bibliographic-data-grant><publication-reference><document-id><country>US</country>
<doc-number>D0{n}</doc-number><kind>S1</kind><date>20120103</date></document-id></publication-reference>
<invention-title>A <b>bold</b> &mdash;x</invention-title>
<references-cited><citation><patcit><document-id><country>US</country><doc-number>1</doc-number><date>19990900</date></document-id></patcit></citation>
<citation><othercit>Other</othercit></citation></references-cited></us-bibliographic-data-grant></us-patent-grant>
"""


def test_concatenated_documents(spark, tmp_path):
    (tmp_path / "ipg120103.xml").write_text(GRANT.format(n=1) + GRANT.format(n=2))
    (tmp_path / "ipg130122.xml").write_text(GRANT.format(n=3).replace("</invention-title>", ""))
    found = documents.read_documents(spark, str(tmp_path), r"\.XML$")
    assert sorted((r.file_date, r.layout) for r in found.collect()) == [(20120103, "v42"), (20120103, "v42"), (20130122, "v44")]
    grants = shred.parse_grants(found)
    assert sorted(r.patent for r in grants.collect()) == ["D1", "D2"]
    assert {r.title for r in shred.descriptions(grants).collect()} == {"A BOLD X"}
    cited = shred.citations(grants).collect()
    assert [(str(c.cit_day), c.citseq) for c in cited] == [("1999-09-01", 0)] * 2
    assert [r.descrip for r in shred.other_references(grants).collect()] == ["OTHER", "OTHER"]
    assert shred.bad_documents(found).select("reason").first()[0] == "not well-formed"
    assert documents.list_files(spark, str(tmp_path), "^IPG12").count() == 1


def test_related_documents_keep_the_order_of_the_text(spark):
    def doc(number):
        return f"<document-id><country>US</country><doc-number>{number}</doc-number></document-id>"

    def relation(*numbers):
        return "<relation>" + "".join(f"<{n}>{doc(v)}</{n}>" for n, v in numbers) + "</relation>"

    parts = [
        f"<us-provisional-application>{doc(1)}</us-provisional-application>",
        f"<division>{relation(('parent-doc', 2), ('child-doc', 3))}</division>",
        "<!-- <division></division> -->",
        f"<continuation-in-part>{relation(('parent-doc', 4))}{relation(('child-doc', 5))}</continuation-in-part>",
        "<reissue/>",
        f"<division a='b'>{relation(('child-doc', 6))}</division>",
        f"<related-publication>{doc(7)}</related-publication>",
        f"<continuation>{relation(('parent-doc', 8))}</continuation>",
        f"<us-provisional-application\n>{doc(9)}</us-provisional-application>",
        f"<reissue>{relation(('parent-doc', 10))}</reissue>",
    ]
    body = GRANT.format(n=1).replace("<references-cited>", f"<us-related-documents>{''.join(parts)}</us-related-documents><references-cited>")
    rows = [("us-patent-grant", text[text.index("<us-patent-grant lang"):]) for text in (body, GRANT.format(n=2))]
    grants = shred.parse_grants(spark.createDataFrame(rows, "root string, body string"))
    rows = sorted(shred.related_documents(grants).collect(), key=lambda r: r.seq)
    assert [(r.seq, r.relpatent) for r in rows] == [(i, str(i + 1)) for i in range(10)]
    assert [r.doctype for r in rows] == [
        "US-PROVISIONAL-APPLICATION", "DIVISION", "DIVISION", "CONTINUATION-IN-PART", "CONTINUATION-IN-PART", "DIVISION", "RELATED-PUBLICATION",
        "CONTINUATION", "US-PROVISIONAL-APPLICATION", "REISSUE"]
    assert {r.patent for r in rows} == {"D1"}


def test_claims(spark, tmp_path):
    block = "<PATDOC DTD='2'><B110><DNUM><PDAT>D04</PDAT></DNUM></B110><CL><CLM ID='1'><PARA><PTEXT><PDAT>One &amp;</PDAT></PTEXT></PARA></CLM></CL></PATDOC>\n"
    (tmp_path / "c.xml").write_text("<?xml?>\n<!DOCTYPE PATDOC []>\n" + block + block.replace("One", "Two"))
    rows = claims.read_claims(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("D04", 0, "One "), ("D04", 0, "Two ")]


def test_spec_headed_file(spark, tmp_path):
    (tmp_path / "gold.csv").write_text("Unique ID,Patent,Last\nINTEGER,VARCHAR,VARCHAR\n,%08d,\nUNIQUE,EXACT,FUZZY\n1,7123456,HUNT\n2,D123,LEE\nUNIQUE,EXACT,FUZZY\n")
    rows, roles = delimited.read_spec_file(spark, str(tmp_path / "gold.csv"))
    assert [tuple(r) for r in rows.collect()] == [(1, "07123456", "HUNT"), (2, "D123", "LEE"), (None, "EXACT", "FUZZY")]
    assert roles == {"UNIQUE": ["UniqueID"], "EXACT": ["Patent"], "FUZZY": ["Last"]}


def test_type_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c,a\n1,1.5,x,"1,000"\n-2,2,3,7\n')
    df = delimited.typed(delimited.read_delimited(spark, str(tmp_path / "t.csv")), overrides={"c": "VARCHAR"})
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "string", "bigint"]
    assert len(set(df.columns)) == 4
    assert delimited.sanitise(["a", "a", "a2"]) == ["a", "a3", "a2"]


def test_values_that_do_not_fit_stay_text(spark, tmp_path):
    rows = [("2001-01-10", "555-1234", "1", 'say "hi", ok'), ("1-2", "1,000", "2", "two\nlines"), ("3", "7", "", "x")]
    sinks.write_csv(spark.createDataFrame(rows, "d string, p string, n string, t string").coalesce(1), str(tmp_path / "v"))
    df = delimited.typed(delimited.read_delimited(spark, str(tmp_path / "v")))
    assert sorted(tuple(r) for r in df.collect()) == sorted(rows)


def test_streams_over_two_runs(spark, tmp_path):
    import datetime

    from linkloom.streaming import jobs

    day = datetime.datetime(2020, 1, 1)
    schema = "user_id long, event_type string, ts timestamp"

    def add(rows):
        spark.createDataFrame([(u, t, day + datetime.timedelta(hours=h)) for u, t, h in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = jobs.table_stream(spark, str(tmp_path / "in"), "*.parquet", schema)
        counts = jobs.windowed_counts(stream, ["event_type"], "ts", "1 day", "1 day")
        jobs.write_upserts(counts, str(tmp_path / "c"), str(tmp_path / "cs"))
        first = jobs.first_seen(stream, ["user_id"], "ts")
        jobs.write_upserts(first, str(tmp_path / "f"), str(tmp_path / "fs"))
        jobs.write_pairs(stream, "event_type", "user_id", "ts", "1 day", "1 day", str(tmp_path / "p"), str(tmp_path / "ps"), hot_rows=2)
        return (
            sorted((r.event_type, r.n) for r in jobs.read_upserts(spark, str(tmp_path / "c"), counts.schema, ["window_start", "event_type"]).collect()),
            sorted((r.user_id, r.event_type) for r in jobs.read_upserts(spark, str(tmp_path / "f"), first.schema, ["user_id"]).collect()),
            sorted((r.src, r.dst, r.weight) for r in jobs.read_pairs(spark, str(tmp_path / "p")).collect()),
        )

    add([(1, "x", 5), (2, "x", 6), (2, "y", 7)])
    assert run() == ([("x", 2), ("y", 1)], [(1, "x"), (2, "x")], [(1, 2, 1)])
    add([(1, "y", 3), (3, "y", 9), (2, "y", 9)])
    assert run() == ([("x", 2), ("y", 4)], [(1, "y"), (2, "x"), (3, "y")], [(1, 2, 2), (1, 3, 1), (2, 3, 1)])


def test_scratch_folder_must_be_shared():
    import pytest

    from linkloom import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster())


def test_gazetteers(spark, tmp_path):
    (tmp_path / "g.txt").write_text("LAT\tLONG\tCC1\tSHORT_FORM\tSORT_NAME_RO\tFULL_NAME_RO\tFULL_NAME_ND_RO\n1.5\t2\tFR\t\tPARIS\tParis\tParis\n")
    (tmp_path / "n.txt").write_text("﻿FEATURE_NAME|STATE_ALPHA|PRIM_LAT_DEC|PRIM_LONG_DEC\nBoston|MA|42.3|-71\n", encoding="utf-8")
    assert tuple(delimited.read_foreign_gazetteer(spark, str(tmp_path / "g.txt")).first()) == ("FR", 1.5, 2.0, "PARIS", "PARIS", "", "PARIS")
    assert tuple(delimited.read_national_gazetteer(spark, str(tmp_path / "n.txt")).first()) == ("Boston", "MA", 42.3, -71.0)


def test_folded_csv_and_column_types(spark, tmp_path):
    df = spark.createDataFrame([("é", 1, 2.0)], "t string, i int, d double")
    sinks.write_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).first()[0] == "e"
    assert sinks.column_types(df, {"t": "TEXT"}) == {"t": "TEXT", "i": "INTEGER", "d": "DOUBLE"}


def test_graphml_is_well_formed(spark, tmp_path):
    import glob
    from xml.dom.minidom import parseString

    vertices = spark.createDataFrame([(1, 7, "a&b"), (1, 8, "c")], "win int, person int, label string")
    edges = spark.createDataFrame([(1, 7, 8, 2)], "win int, src int, dst int, weight int")
    sinks.write_graphml(sinks.graphml_lines(vertices, edges, ["label"], ["weight"]), str(tmp_path / "g"))
    text = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / "g" / "win=1" / "*.txt"))))
    assert len(parseString(text).getElementsByTagName("node")) == 2


def test_rows_days_late_are_in_the_result(spark, tmp_path):
    from linkloom.streaming import jobs

    for days in ([("10", 1), ("10", 2)], [("12", 3)], [("01", 1), ("01", 2)]):
        rows = spark.createDataFrame([(f"2024-01-{d} 00:00:00", "a", m) for d, m in days], "t string, g string, m long")
        rows.selectExpr("CAST(t AS TIMESTAMP) AS ts", "g", "m").write.mode("append").parquet(f"{tmp_path}/in")
        stream = jobs.table_stream(spark, f"{tmp_path}/in", "*.parquet", spark.read.parquet(f"{tmp_path}/in").schema)
        counts = jobs.windowed_counts(stream, ["g"], "ts", None, "1 day")
        jobs.write_upserts(counts, f"{tmp_path}/counts", f"{tmp_path}/state")
        jobs.write_pairs(stream, "g", "m", "ts", None, "1 day", f"{tmp_path}/p", f"{tmp_path}/pairs-state")
    got = jobs.read_upserts(spark, f"{tmp_path}/counts", counts.schema, ["window_start", "g"]).collect()
    assert {(r.window_start.day, r.n) for r in got} == {(10, 2), (12, 1), (1, 2)}
    assert {(r.window_start.day, r.src, r.dst) for r in jobs.read_pairs(spark, f"{tmp_path}/p").collect()} == {(10, 1, 2), (1, 1, 2)}


def test_a_whole_graphml_file_per_window(spark, tmp_path):
    import glob
    from xml.dom.minidom import parse

    vertices = spark.range(900).selectExpr("int(id % 3) AS win", "concat('p\"&', id) AS person", "concat('a<b', char(1), '\n', id) AS label").repartition(40)
    edges = spark.range(600).selectExpr("int(id % 3) AS win", "concat('p\"&', id) AS src", "concat('p\"&', id + 3) AS dst", "id AS weight").repartition(40)
    sinks.write_graphml_files(sinks.graphml_lines(vertices, edges, ["label"], ["weight"]), str(tmp_path / "g"))
    files = glob.glob(str(tmp_path / "g" / "win=*" / "*.txt"))
    assert len(files) == 3
    for file in files:
        document = parse(file)
        ids = {n.getAttribute("id") for n in document.getElementsByTagName("node")}
        assert len(ids) == 300 and len(document.getElementsByTagName("edge")) == 200
        assert {e.getAttribute("source") for e in document.getElementsByTagName("edge")} <= ids
