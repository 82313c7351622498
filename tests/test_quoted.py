"""Files with quoted line ends: cut into many splits, the records equal those of a reader that reads a file as one."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from linkloom.sources import delimited, quoted


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def make(path, end, seed, rows=1500):
    rng = random.Random(seed)
    cells = ["x", "", 'say "hi"', "two\nlines", "a,b", "\n", '"', 'é\n"\n"', "long\n" * 40, " y "]
    data = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(rows)]
    # one record over several splits
    data[rows // 2][1] = 'much "text",\n' * 1500
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(["id", "a", "b\nb"])
        writer.writerows(data)
    return data


def text(v):
    return "" if v is None else v


def test_records_cross_splits(spark, tmp_path, small_splits):
    want = make(tmp_path / "one.csv", "\n", 1) + make(tmp_path / "two.csv", "\r\n", 2)
    path = str(tmp_path)
    lines = quoted._lines(spark, path)
    assert lines.select("file_name", "block").distinct().count() > 20 and lines.rdd.getNumPartitions() > 20
    df = delimited.read_delimited(spark, path)
    assert df.columns == ["id", "a", "bb"]
    got = [tuple(text(v) for v in r) for r in df.collect()]
    assert sorted(got) == sorted(map(tuple, want))
    # as Spark reads a file as a whole, which leaves a CR in the last field of CR LF files
    path = f"{path}/one.csv"
    whole = spark.read.csv(path, header=True, quote='"', escape='"', nullValue="\u0000", emptyValue="", multiLine=True)
    one = delimited.read_delimited(spark, path)
    assert sorted(map(str, map(tuple, one.collect()))) == sorted(map(str, map(tuple, whole.collect())))


def test_order_and_numbers_of_records(spark, tmp_path, small_splits):
    want = make(tmp_path / "f.csv", "\n", 3)
    records = quoted.quoted_records(spark, str(tmp_path / "f.csv"))
    ids = [r.value.split(",")[0] for r in records.orderBy("block", "line").collect()]
    assert ids == ["id"] + [row[0] for row in want]
    assert [r.nth for r in records.where("block = 0").orderBy("line").limit(5).collect()] == [1, 2, 3, 4, 5]


def test_blank_lines_marks_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbf\r\na,b\r\n\r\n1,"x\r\n\r\ny"\r\n\n2,\r\n3\r\n4,5,6')
    (tmp_path / "empty.csv").write_text("")
    got = delimited.read_delimited(spark, str(tmp_path / "a.csv")).collect()
    assert sorted((r[0], r[1]) for r in got if r[1]) == [("1", "x\r\n\r\ny"), ("4", "5")]
    assert len(got) == 4
    assert delimited.read_delimited(spark, str(tmp_path / "empty.csv"), header=False).count() == 0


def test_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="not closed"):
        delimited.read_delimited(spark, str(tmp_path / "bad.csv")).collect()


def test_spec_file_with_line_ends(spark, tmp_path, small_splits):
    rows = "".join(f'{i},{i},"N{i}\nUNIQUE,EXACT"\n' for i in range(3000))
    (tmp_path / "gold.csv").write_text('Unique ID,"Pat\nent",Last\nINTEGER,VARCHAR,VARCHAR\n,%08d,\nUNIQUE,EXACT,FUZZY\n' + rows)
    df, roles = delimited.read_spec_file(spark, str(tmp_path / "gold.csv"))
    assert roles == {"UNIQUE": ["UniqueID"], "EXACT": ["Patent"], "FUZZY": ["Last"]}
    assert df.count() == 3000
    bad = df.where((F.col("Patent") != F.lpad(F.col("UniqueID").cast("string"), 8, "0")) | ~F.col("Last").endswith("\nUNIQUE,EXACT"))
    assert bad.count() == 0
