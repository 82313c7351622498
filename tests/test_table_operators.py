"""Operators against brute force and their properties."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from linkloom.bindings import duck
from linkloom.operators import aggregates, similarity_join, skew, tables, upsert
from linkloom.operators.components import connected_components
from linkloom.operators.ranking import global_index, index_within
from linkloom.operators.update_join import update_join
from linkloom.plans import graph


def _words(seed, n):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("ABCDEFGH TE") for _ in range(rng.randint(3, 16))) for _ in range(n // 6)]

    def damage(word):
        letters = list(word)
        for _ in range(rng.randint(0, 2)):
            letters[rng.randrange(len(letters))] = rng.choice("ABCDEQ")
        return "".join(letters)

    return sorted({damage(rng.choice(bases)) for _ in range(n)})


@pytest.mark.parametrize("threshold,hot_rows,small", [(0.90, 20_000, 4096), (0.95, 5, 0), (0.60, 7, 0)])
def test_similar_pairs_equals_all_pairs(spark, monkeypatch, threshold, hot_rows, small):
    """The token join, its hot-key cells and the small-block path all give the full result."""
    monkeypatch.setattr(similarity_join, "SMALL_BLOCK", small)
    monkeypatch.setattr(
        similarity_join, "chunked_equi_join",
        lambda *a, **k: skew.chunked_equi_join(*a, **{**k, "hot_rows": hot_rows}),
    )
    words = _words(3, 260)
    df = spark.createDataFrame([(i, w, w[:1]) for i, w in enumerate(words)], "id long, t string, b string")
    left = df.select("b", F.col("id").alias("i"), F.col("t").alias("x"))
    right = df.select("b", F.col("id").alias("j"), F.col("t").alias("y"))
    rows = similarity_join.similar_pairs(left, right, ["b"], "x", "y", threshold, F.col("i") < F.col("j"), one_table=True).collect()
    got = {(r.i, r.j): r.similarity for r in rows}
    # the comparator's SQL form is the second implementation
    base = duckdb.connect()
    base.execute("CREATE TABLE w(i INTEGER, t VARCHAR)")
    base.executemany("INSERT INTO w VALUES (?, ?)", list(enumerate(words)))
    scored = base.execute(f"""WITH src AS (SELECT a.t AS a, b.t AS b FROM w a JOIN w b ON a.i < b.i AND left(a.t, 1) = left(b.t, 1)), {duck.jarow_ctes('jw', 'src')}
        SELECT x.i, y.i, j FROM jw JOIN w x ON x.t = jw.a JOIN w y ON y.t = jw.b WHERE j > {threshold}""").fetchall()
    want = {(i, j): value for i, j, value in scored}
    assert len(rows) == len(got)
    assert got == pytest.approx(want)


def test_components_do_not_depend_on_order(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(50), rng.randrange(50)) for _ in range(35)]
    root = list(range(50))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    vertices = spark.range(50).withColumnRenamed("id", "n")
    for edges in (pairs, [(b, a) for a, b in reversed(pairs)]):
        found = connected_components(vertices, spark.createDataFrame(edges, "a long, b long"), "n", "a", "b").collect()
        assert {r.n: r.component for r in found} == {i: find(i) for i in range(50)}


def test_hot_key_is_numbered_across_ranges(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice("aaaab"), rng.randrange(40), i) for i in range(400)], "k string, v int, i int")
    rows = index_within(df, ["k"], [F.col("v"), F.col("i")], "pos").collect()
    for key in "ab":
        mine = sorted((r.v, r.i, r.pos) for r in rows if r.k == key)
        assert [m[2] for m in mine] == list(range(len(mine)))
    everything = global_index(df, [F.col("v"), F.col("i")], "pos", start=1).collect()
    assert [r.pos for r in sorted(everything, key=lambda r: (r.v, r.i))] == list(range(1, 401))


def test_values_keep_one_shape_at_every_size(spark):
    df = spark.createDataFrame([("a", i % 7) for i in range(300)] + [("b", 1)], "k string, v int")
    rows = sorted(tuple(r) for r in aggregates.ordered_values(df, ["k"], "v", "v").collect())
    assert rows == [("a", i, v) for i, v in enumerate(sorted(i % 7 for i in range(300)))] + [("b", 0, 1)]
    once = sorted(tuple(r) for r in aggregates.unique_values(df, ["k"], "v", "u").collect())
    assert once == [("a", i, str(i)) for i in range(7)] + [("b", 0, "")]
    joined = {r.k: (r.s, r.n_values) for r in aggregates.joined_values(df, ["k"], "v", "s").collect()}
    assert joined["b"] == ("1", 1) and joined["a"][1] == 300


def test_key_hot_on_one_side_copies_the_other_only(spark):
    left = spark.range(2_000).select(F.lit("h").alias("k"), F.col("id").alias("a"))
    right = spark.createDataFrame([("h", 1), ("c", 2)], "k string, b long")
    sides = skew.chunked_sides(left, right, ["k"], F.col("a"), F.col("b"), hot_rows=100)
    assert [s.count() for s in sides] == [2_000, 20 + 1]
    for hot_rows in (100, 10_000):
        joined = skew.chunked_equi_join(left, right, ["k"], F.lit(True), F.col("a"), F.col("b"), hot_rows)
        assert sorted(r.a for r in joined.collect()) == list(range(2_000))


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", F.col("id").cast("string").alias("t"))
    picks = [sorted(r.id for r in tables.sample_rows(df.repartition(n), ["id"], ["id"], 20, seed=3).collect()) for n in (1, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 20


def test_upsert_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, o int, v string")
    once = upsert.insert_or_ignore(df, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == [(1, 1, "a"), (2, 5, "c")]
    assert sorted(map(tuple, upsert.insert_or_ignore(df, ["k"], ["o"], once).collect())) == [(1, 1, "a"), (2, 5, "c")]
    assert sorted(map(tuple, upsert.insert_or_replace(df, ["k"], ["o"], once).collect())) == [(1, 2, "b"), (2, 5, "c")]


def test_update_join_writes_null(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    source = spark.createDataFrame([(1, None)], "s int, w string")
    got = update_join(target, source, {"k": "s"}, {"v": "w", "z": "w"}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, None, None), (2, "y", None)]


def test_betweenness_equals_path_counting(spark):
    rng = random.Random(9)
    nodes = range(12)
    pairs = sorted({tuple(sorted(rng.sample(nodes, 2))) for _ in range(18)})
    near = {n: {b for a, b in pairs if a == n} | {a for a, b in pairs if b == n} for n in nodes}

    def paths(s, t):
        level = [[s]]
        while level:
            done = [p for p in level if p[-1] == t]
            if done:
                return done
            level = [p + [n] for p in level for n in near[p[-1]] if n not in p]
        return []

    want = {n: 0.0 for n in nodes if near[n]}
    for s, t in itertools.combinations(nodes, 2):
        # only the shortest ones: the search above goes level by level
        found = paths(s, t)
        for p in found:
            for n in p[1:-1]:
                want[n] += 1 / len(found)
    edges = spark.createDataFrame([(0, a, b, 1) for a, b in pairs], "win int, src int, dst int, weight int")
    got = {r.person: r.betweenness for r in graph.betweenness(edges).collect()}
    assert got == pytest.approx(want)


def test_one_document_with_many_persons(spark):
    members = spark.createDataFrame([(0, "d", i) for i in range(60)] + [(0, "e", 1), (0, "e", 2)], "win int, doc string, person int")
    edges = graph.edges_of(members)
    assert edges.count() == 60 * 59 // 2
    degrees = {r.person: (r.degree, r.unique_degree) for r in graph.degrees(members, edges).collect()}
    assert degrees[1] == (60, 59) and degrees[5] == (59, 59)
    assert {r.component for r in graph.components(members).collect()} == {0}
