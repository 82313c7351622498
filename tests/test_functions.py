"""Expression vectors."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import dates, ids, names, places, similarity, text


def apply(spark, rule, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_name(spark):
    cases = {
        "FOO": "FOO", "verité": "verité", "1.0": "10", "foo&bar": "foobar", "f+=_oo@b!#$%^&*(){}ar": "foobar", " +": "",
        "foo, |||,,,  ,, |,,, bar": "foo     bar", "{foo bar}": "", "(foo bar)": "", "hello. there": "hello there",
        "KIN-JOE": "KIN-JOE", "{UMLAUT OVER (A)}B": "AB",
    }
    assert apply(spark, text.clean_name, cases) == list(cases.values())
    assert apply(spark, lambda c: text.clean_name(c, strict=False), ["1.0"]) == ["1.0"]


def test_clean_assignee(spark):
    assert apply(spark, text.clean_assignee, ["A-B, C. (D)", "A|B+C"]) == ["AB C", "A|B+C"]


def test_fold_ascii(spark):
    assert apply(spark, text.fold_ascii, ["Éçà", "ﬁne ½ …", "Straße", "plain", "한글x"]) == ["Eca", "fine 12 ...", "Strae", "plain", "x"]


def test_segments(spark):
    rows = spark.createDataFrame([("foo,bar",), ("foo|bar",), ("foo bar",)], "v string")
    found = rows.select(*[text.segment(F.col("v"), i).alias(f"s{i + 1}") for i in (-1, 0, 1)]).collect()
    assert [tuple(r) for r in found] == [("foo,bar", "foo", "bar"), ("foo|bar", "foo", "bar"), ("foo bar", "foo bar", "")]


def test_markup(spark):
    assert apply(spark, text.clean_markup, ["a <sub>&#x2014;</sub>\r\n\tb & <i>"]) == ["A _ B &AMP; &LT;I&GT;"]
    assert apply(spark, text.escape_outside_sub, ["<t> & </t>", "<sub>x</sub>&amp;"]) == ["&lt;t&gt; &amp; &lt;/t&gt;", "<sub>x</sub>&amp;"]


def test_markup_keeps_letters(spark):
    assert apply(spark, text.clean_markup, ["a·ß b", "e\u0301 o\u0302\u0301 x\u0301"]) == ["A·ß B", "É Ố X\u0301"]
    assert apply(spark, text.composed, ["u\u0308\u0301 plain", "\u0301"]) == ["ǘ plain", "\u0301"]


def test_zip_number(spark):
    from linkloom.plans.places import zip_number

    assert apply(spark, zip_number, ["02139", "02139-4307", "2139", "", "X1", "000"]) == ["2139", "2139", "2139", "", "", "0"]


def test_document_numbers(spark):
    assert apply(spark, ids.strip_leading_zero, ["US05260728", "USD05260728", "D123456", "D0123456"]) == [
        "US5260728", "USD5260728", "D123456", "D123456"]
    assert apply(spark, ids.simple_number, ["D-0012", "7,123,456"]) == ["D12", "7123456"]
    assert apply(spark, ids.padded_number, ["D12", "7123456"]) == ["D0000012", "07123456"]
    assert apply(spark, ids.class_label, ["428123456", "428123", "428123" + "7" * 300]) == ["428/123.456", "428/123", "428/123." + "7" * 300]


def test_names(spark):
    rows = spark.createDataFrame([("Troy Van Der", "Whol"), ("Troy", "Van Der Whol")], "f string, l string")
    got = rows.select(names.split_given(F.col("f")), names.join_prefix(F.col("f"), F.col("l"))).collect()
    assert [tuple(r) for r in got] == [("Troy", "Van Der Whol")] * 2


def test_dates(spark):
    cases = {"1-Jan-00": "20000101", "12-dec-50": "19501212", "1/10/2001": "2001-01-10", "20010110": "2001-01-10", "May 2001": "May 2001",
             "1-ANF-00": "1-ANF-00", "1-XYZ-00": "1-XYZ-00"}
    assert apply(spark, dates.normalise_date, cases) == list(cases.values())
    assert [str(x) for x in apply(spark, dates.citation_date, ["20100800", ""])] == ["2010-08-01", "None"]
    assert apply(spark, dates.year_list, ["2008,2010-2013,2009", "1975-1978,2000-2002"]) == [
        [2008, 2010, 2011, 2012, 2013, 2009], [1975, 1976, 1977, 1978, 2000, 2001, 2002]]


CITIES = [
    ("ST LOUIS", "US", "SAINT LOUIS"), ("LA", "US", "LOS ANGELES"), ("FT WORTH", "US", "FORT WORTH"),
    ("MT VIEW TOWNSHIP", "US", "MOUNT VIEW"), ("MUENCHEN", "DE", "MUNCHEN"),
    # a postal code leaves an edge blank, and an edge blank costs the last letter
    ("D-80331 MUENCHEN", "DE", "MUNCHE"), ("ITZEHOE", "DE", "ITZEHOE"),
    ("AARHUS C", "DK", "AARHUS"), ("PARIS CEDEX", "FR", "PARIS"), ("TAI-PEI", "TW", "TAIPEI"),
    ("YOKOHAMA, KANAGAWA", "JP", "YOKOHAMA,KANAGAWA"), ("TORONTO, ONTARIO", "CA", "TORONTO,ONTARIO"),
    ("ZÜRICH", "CH", "ZURICH"),
]


def test_city_rules(spark):
    rows = spark.createDataFrame([(i, c, k) for i, (c, k, _) in enumerate(CITIES)], "i int, city string, country string")
    for name, stage in places.normalise_city_stages("city", "country"):
        rows = rows.withColumn(name, stage)
    got = [r._clean_city for r in rows.orderBy("i").collect()]
    assert got == [want for _, _, want in CITIES]


def test_country(spark):
    rows = spark.createDataFrame([("HONG KONG", "CN"), ("BEIJING", "CN"), ("X", "SU"), ("X", "USA")], "c string, k string")
    got = [r[0] for r in rows.select(places.recode_country(F.col("c"), F.col("k"))).collect()]
    assert got == ["HK", "CN", "RU", "US"]


VECTORS = [
    ("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("ABCD", "ABCDE", 0.953333), ("ABCDEF", "CBADEF", 0.822222),
    ("AAAB", "AABC", 0.733333), ("AABC", "AAAB", 0.866667), ("", "X", 0.0), ("SAME", "SAME", 1.0),
]


def test_jarow(spark):
    rows = spark.createDataFrame([v[:2] for v in VECTORS], "a string, b string")
    got = [r.s for r in rows.select(similarity.jarow("a", "b").alias("s")).collect()]
    assert got == pytest.approx([v[2] for v in VECTORS], abs=1e-6)


def test_person_similarity(spark):
    rows = spark.createDataFrame([("THOMAS, DW", "THOMAS, D"), ("THOMAS, DW", "THOMAS, DY")], "a string, b string")
    first, second = [r.s for r in rows.select(similarity.person_similarity("a", "b").alias("s")).collect()]
    assert first > 0.95 and second == 0.0
