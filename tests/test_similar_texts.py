"""Names of many letters in one block: what they carry to each other, and their scores."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions.similarity import common_letters_bound, jarow, jarow_batch, letter_marks
from linkloom.operators import similarity_join, skew


def _names(seed, n):
    rng = random.Random(seed)
    words = ["THE", "HOUSE", "OF", "WIDGETS", "ÉCOLE", "UND", "SÖHNE", "42", "Ж漢", "CO", "INTERNATIONAL", "zoo"]
    bases = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 6, 12, 40]))) for _ in range(n // 4)]

    def damage(text):
        letters = list(text)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(letters))
            letters[at:at + rng.randint(0, 1)] = rng.choice("ABÉXЖ ")
        return "".join(letters)

    return sorted({damage(rng.choice(bases)) for _ in range(n)} - {""})


@pytest.mark.parametrize("threshold,small", [(0.90, 0), (0.95, 0), (0.90, 4096)])
def test_texts_of_all_lengths_equal_all_pairs(spark, monkeypatch, threshold, small):
    monkeypatch.setattr(similarity_join, "SMALL_BLOCK", small)
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(_names(5, 160))], "id long, t string, b int")
    left, right = df.select("b", F.col("id").alias("i"), F.col("t").alias("x")), df.select("b", F.col("id").alias("j"), F.col("t").alias("y"))
    rows = similarity_join.similar_pairs(left, right, ["b"], "x", "y", threshold, F.col("i") < F.col("j"), one_table=True).collect()
    everything = left.join(right, "b").where("i < j").withColumn("s", jarow("x", "y")).where(F.col("s") > threshold).collect()
    assert len(rows) == len(everything) > 20
    assert {(r.i, r.j): r.similarity for r in rows} == {(r.i, r.j): r.s for r in everything}


def test_a_long_name_is_one_row_without_its_letters(spark, monkeypatch):
    """Names of 200 letters went to the join as a hundred rows each, with a list of all letters in each row."""
    seen = []

    def watched(left, right, *rest, **more):
        seen.extend([left, right])
        return skew.chunked_equi_join(left, right, *rest, **more)

    monkeypatch.setattr(similarity_join, "chunked_equi_join", watched)
    rng = random.Random(2)
    names = ["".join(rng.choice("ETAOIN SHRDLU") for _ in range(200)) for _ in range(80)]
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([*names, names[0][:-1]])], "b int, id long, t string")
    left, right = df.select("b", F.col("id").alias("i"), F.col("t").alias("x")), df.select("b", F.col("id").alias("j"), F.col("t").alias("y"))
    rows = similarity_join.similar_pairs(left, right, ["b"], "x", "y", 0.9, F.col("i") < F.col("j"), one_table=True).collect()
    assert [(r.i, r.j) for r in rows] == [(0, 80)]
    assert [side.count() for side in seen] == [81, 81]
    letters = max(len(v) for side in seen for row in side.collect() for v in row if isinstance(v, list))
    assert letters < 20


def test_batch_scores_are_those_of_the_expression(spark):
    rng = random.Random(4)
    wide = [chr(0x4E00 + i) for i in range(400)]
    pairs = [("a", "b"), ("ab", "b"), ("a", "ab"), ("", ""), ("", "x"), ("a", "a"), ("A\u0001B", "AB\u0001\u0001")]
    for kinds in ("AB CDE", "AÉ\u0001B", "ABЖ漢", wide):
        for _ in range(60):
            a = [rng.choice(kinds) for _ in range(rng.randint(1, 30 if len(kinds) < 99 else 300))]
            b = [rng.choice(kinds) if rng.random() < 0.2 else c for c in a][rng.randint(0, 3):]
            pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    df = df.withColumns({"x": jarow("a", "b"), "y": jarow_batch("a", "b"), "ma": letter_marks("a"), "mb": letter_marks("b")})
    bound = common_letters_bound([f"ma[{i}]" for i in range(10)], [f"mb[{i}]" for i in range(10)])
    for r in df.withColumn("bound", F.expr(bound)).collect():
        assert r.x == r.y
        assert r.bound >= sum(min(r.a.count(c), r.b.count(c)) for c in set(r.a))
