"""Phrases, quality votes and word runs on small tables with odd rows, against plain brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_words string, runs string, score string, size string, label string, rank string"
WORDS = "the of alpha beta gamma delta epsilon zeta".split()


def prose(seed: int, n: int, words=WORDS) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def odd_rows() -> list[tuple]:
    texts = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t\r ", None), (4, "one", None), (5, prose(1, 9000), "en"), (6, prose(2, 400), None), (6, prose(2, 400), None),
        (7, "New York! new york, NEW\tYORK\x0bnew york; new york " * 40, "en"), (None, prose(3, 300), "en"), (None, None, None), (8, "ä" * 500, ""),
        (9, "no break in\x1chere " * 50, "x y"), (10, "a b c d " * 60 + "e", "fr"), (11, "z " * 3000, "fr"), (12, prose(4, 50, ["a", "b"]), "fr"),
    ]
    return [(i, t, lang, "s", "x", "x", "x", "x", "x", "x") for i, t, lang in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ---- 11: collocations

def phrase_counts(docs, longest: int):
    words, counts = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for size in range(1, longest + 1):
                counts.update((lang, " ".join(found[i : i + size])) for i in range(len(found) - size + 1))
    return words, counts


def plain_collocations(docs, support: int, longest: int, top: int):
    words, counts = phrase_counts(docs, longest)
    scored = {}
    for (lang, phrase), a in counts.items():
        parts = phrase.split(" ")
        if len(parts) > 1 and a >= support:
            cuts = [(counts[lang, " ".join(parts[:k])], counts[lang, " ".join(parts[k:])]) for k in range(1, len(parts))]
            score, _, left, right = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            scored[lang, phrase] = (a, left, right, score)
    inner = {}
    for (lang, phrase), (a, *_) in scored.items():
        parts = phrase.split(" ")
        for size in range(2, len(parts)):
            for i in range(len(parts) - size + 1):
                key = (lang, " ".join(parts[i : i + size]))
                inner[key] = max(inner.get(key, 0), a)
    left = {k: v for k, v in scored.items() if 100 * inner.get(k, 0) < 80 * v[0]}
    out = []
    for lang in {k[0] for k in left}:
        order = sorted((k for k in left if k[0] == lang), key=lambda k: (-left[k][3], -left[k][0], k[1].encode()))[:top]
        out += [(lang, n, k[1], *left[k][:3], words[lang], left[k][3]) for n, k in enumerate(order, 1)]
    return sorted(out)


@pytest.mark.parametrize("support,longest,block", [(30, 4, 1_000_000), (5, 4, 700), (2, 3, 50)])
def test_collocations_equal_brute_force(odd, support, longest, block):
    from linkloom.llm.collocations import collocations

    got = collocations(odd, support=support, longest=longest, top=60, block_words=block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations([(r[1], r[2]) for r in odd_rows()], support, longest, 60)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 20


def test_frequent_phrases_are_whole_and_empty_tables_give_none(odd, none):
    from linkloom.llm.collocations import collocations, frequent_phrases

    phrases, words = frequent_phrases(odd, support=4, block_words=200)
    n, counts = phrase_counts([(r[1], r[2]) for r in odd_rows()], 4)
    assert {(r.lang, r.phrase): r.f for r in phrases.collect()} == {k: c for k, c in counts.items() if c >= 4}
    assert {r.lang: r.n for r in words.collect()} == {k: c for k, c in n.items() if c}
    assert collocations(none).count() == 0
    assert collocations(none.unionByName(odd.where("doc_id < 4"))).count() == 0


def test_scores_past_64_bits_are_exact(spark):
    big = 9_000_000_000_000_000
    row = spark.range(1).select(F.lit(big).alias("a"), F.lit(big + 1).alias("l"), F.lit(big + 7).alias("r"))
    got = row.select(F.expr("CAST(CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + r) AS BIGINT)")).first()[0]
    assert got == 2_000_000 * big // (2 * big + 8)


# ---- 12: votes of neighbours

def junk(seed: int) -> str:
    rnd = random.Random(seed)
    kind = rnd.randrange(3)
    if kind == 0:
        return " | ".join(rnd.choice(WORDS) for _ in range(80))
    if kind == 1:
        return " ".join(rnd.choice(WORDS).upper() + "!!" for _ in range(60))
    return " ".join(w for _ in range(8) for w in [rnd.choice(WORDS)] * 15)


def test_votes_tell_held_out_texts_apart(spark, odd, none):
    from linkloom.llm.neighbour_quality import score_quality

    docs = [(1000 + k, junk(k) if k % 4 == 0 else prose(k, 90)) for k in range(400)]
    table = spark.createDataFrame([(i, t, "en", "s", *["x"] * 6) for i, t in docs], DOCS)
    labels = spark.createDataFrame([(i, int((i - 1000) % 4 != 0), 0) for i, _ in docs if i % 5] + [(None, 0, 0), (1001, None, 1), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    both = table.unionByName(odd)
    scores = score_quality(both, labels, neighbours=9)
    assert scores.columns == ["doc_id", "score"]
    rows = scores.collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 for r in rows)
    held = [((r.doc_id - 1000) % 4 != 0, r.score >= 0.3) for r in rows if r.doc_id is not None and r.doc_id >= 1000 and r.doc_id % 5 == 0]
    assert len(held) == 80 and sum(a == b for a, b in held) >= 78
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    # blank texts take the share of label 1, equal texts have equal scores
    assert by_id[1] == by_id[2] == by_id[3] and len(by_id[6]) == 1
    # a bound on the labelled texts is a bound on the neighbours, not on the scored texts
    assert score_quality(both, labels, fit_rows=5).count() == both.count()
    assert {r.score for r in score_quality(odd, labels.where("false")).collect()} == {0.5}
    assert score_quality(none, labels).count() == 0


def test_cosines_are_exact_in_blocks(spark):
    import numpy as np

    from linkloom.llm.neighbour_quality import _BLOCK, Votes, _placed, _terms, vote

    texts = [prose(k, 60) if k % 3 else junk(k) for k in range(2 * _BLOCK + 5)]
    rng = np.random.default_rng(1)
    weights, directions = rng.random(_terms(["a"]).shape[1]) + 0.5, rng.standard_normal((_terms(["a"]).shape[1], 8))
    sample = _placed(_terms(texts[:40]), weights, directions)
    labels = np.arange(40) % 2.0
    got = vote(texts, Votes(weights, directions, sample, labels, 0.5), 5, 4.0)
    for i in (0, 39, 40, _BLOCK, 2 * _BLOCK + 4):
        one = _placed(_terms([texts[i]]), weights, directions)[0].astype(float)
        cosine = np.maximum(np.round([sum(a * b for a, b in zip(one, v.astype(float))) for v in sample], 5), 0)
        weight = np.where(cosine >= sorted(cosine)[-5], cosine**4, 0)
        assert abs(got[i] - (weight @ labels / weight.sum() if weight.sum() else 0.5)) < 1e-3


def test_long_texts_are_counted_whole():
    import numpy as np

    from linkloom.llm import neighbour_quality as Q

    text = prose(5, 3000)
    whole = Q.term_counts(text)
    keep, Q._SLICE = Q._SLICE, 700
    try:
        cut = Q.term_counts(text)
    finally:
        Q._SLICE = keep
    # only trigrams and triples over a cut are not seen
    assert abs(whole - cut)[Q._TRIGRAMS : -3].sum() == 0 and abs(whole - cut)[:-3].sum() < 200 and cut[-1] == whole[-1]
    assert np.count_nonzero(Q.term_counts("")) == np.count_nonzero(Q.term_counts(None)) == 0


# ---- 13: runs

def plain_runs(w, least: int, times: int):
    best = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            start = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, times * q):
                best.setdefault((start, i + q - start), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_of_random_words_equal_brute_force():
    from linkloom.llm.periodic_runs import runs_of

    rnd = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            w = []
            while rnd.random() < 0.8:
                unit = [rnd.choice([b"a", b"b", b"c"][: rnd.randint(1, 3)]) for _ in range(rnd.randint(1, 5))]
                w += unit * rnd.randint(1, 7) + unit[: rnd.randint(0, len(unit))]
            texts.append(w)
        least, times = rnd.choice([(6, 4), (6, 4), (2, 2), (4, 3), (9, 4)])
        assert runs_of(texts, least, times) == [plain_runs(t, least, times) for t in texts]
    # one task's time stays near linear for one run over a whole long text, and many runs within each other
    assert runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    nested = ([b"a"] * 9 + [b"b"]) * 500
    assert (0, 5000, 10) in runs_of([nested])[0] and len(runs_of([nested])[0]) == 501


def test_runs_of_odd_rows(odd, none):
    from linkloom.llm.periodic_runs import periodic_runs

    for least, times in ((6, 4), (3, 2)):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(odd, least, times).collect())
        want = []
        for i, text, *_ in odd_rows():
            w = words_of(text)
            w = w if len(w) < 5000 else w
            runs = plain_runs(w, least, times) if len(w) < 5000 else None
            want.append((i is None, i or 0, len(w), runs, None if runs is None else collapsed(w, runs)))
        want.sort(key=lambda r: r[:3])
        assert len(got) == len(want)
        for g, x in zip(got, want):
            assert g[:3] == x[:3] and (x[3] is None or g[3:] == x[3:])
    assert periodic_runs(none).count() == 0


def test_query_of_runs_follows_the_planted_ends(spark, tmp_path):
    from linkloom.llm.bound import QUERIES

    rnd = random.Random(9)
    docs = [(i, None if i == 40 else " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 120)))) for i in range(1, 200)] + [(None, "q " * 9), (-5, "")]
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    want = []
    for i, text in docs:
        w = words_of(text)
        n = len(w)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = plain_runs(w, 6, 4)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        s, length, q = best or (None, None, None)
        text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.append((i, len(runs), s, length, q, 1000 * length // q if best else None, hashlib.sha256(text.encode()).hexdigest(),
                     hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op13_word_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[1] > 0 for r in want) > 5
