"""MinHash near-duplicates by a multi-index Hamming join.

Texts with equal shingle sets form a class; classes get a b-bit MinHash signature.  The signature is
split into chunks, and each chunk is indexed under every set of its components that remains when
one component is left out.  By the pigeonhole principle two signatures that differ in fewer than
twice as many components as there are chunks share a key: one chunk then holds at most one
error.  Candidates are confirmed on the full shingle sets.

A key's classes are never paired all with all.  Each class meets leaders of its keys first; the
confirmed links merge most of a key's classes into one component.  In the next round the leaders are the
classes with most company, such as the text that all others of a group were made from.  Only classes of different
components are compared further, in cells of bounded size: by longer sketches, then on the full sets.  A cell puts out its
members that are near one of another component, then links that join components: never more rows than members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.store import written
from linkloom.operators.components import connected_components

CHUNK = 7
N_CHUNKS = 14
N_HASHES = CHUNK * N_CHUNKS
#: Sketches for the last comparisons: 2 bits of 1,024 hashes.  At similarity 0.8 three quarters of 0.2 differ on
#: average; pairs up to five standard deviations above that are confirmed on the full sets.
N_SKETCH = 1024
LOOSE = 0.15 + 5 * (0.15 * 0.85 / N_SKETCH) ** 0.5
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RNG = np.random.default_rng(20_240_501)
_MULTIPLY = _RNG.integers(0, 1 << 32, N_HASHES, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, N_HASHES, dtype=np.uint32)
_SKETCH_MULTIPLY = _RNG.integers(0, 1 << 32, N_SKETCH, dtype=np.uint32) | np.uint32(1)
_SKETCH_ADD = _RNG.integers(0, 1 << 32, N_SKETCH, dtype=np.uint32)
#: How many of a byte's four 2-bit fields are not zero.
_FIELDS = np.array([sum(b >> shift & 3 != 0 for shift in (0, 2, 4, 6)) for b in range(256)], np.uint8)
_CELL = 1000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return (x ^ (x >> np.uint64(29))) * _B


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; fewer words are one shingle."""
    if len(_WORDS) > 1_000_000:
        _WORDS.clear()
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    out = np.full(len(parts) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mixed(out + hashes[i : len(parts) - size + 1 + i])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def _least(shingles: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    least = np.full(len(multiply), 0xFFFFFFFF, np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    step = max(1, 100_000 // len(multiply))
    for lo in range(0, len(high), step):
        np.minimum(least, (high[lo : lo + step, None] * multiply + add).min(0), out=least)
    return least


def _signature(shingles: np.ndarray) -> np.ndarray:
    return _least(shingles, _MULTIPLY, _ADD).astype("<u2")


def _sketch(shingles: np.ndarray) -> bytes:
    fields = (_least(shingles, _SKETCH_MULTIPLY, _SKETCH_ADD) * np.uint32(0x9E3779B1)) >> np.uint32(30)
    return (fields.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint32)).sum(1).astype(np.uint8).tobytes()


def _sketched(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_sketch(s) for s in sets], pa.binary())],
                                         ["rep", "n_shingles", "sketch"])


def _described(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, sets, signatures = [], [], []
        for text in batch.column(1).to_pylist():
            own = shingle_set(text, words)
            sizes.append(len(own))
            sets.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            signatures.append(_signature(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())],
            ["doc_id", "n_shingles", "set_id", "signature"])


def _keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature, by chunk and component left out."""
    place = np.arange(N_HASHES, dtype=np.uint64).reshape(N_CHUNKS, CHUNK)
    terms = _mixed(signatures.reshape(-1, N_CHUNKS, CHUNK).astype(np.uint64) + (place << np.uint64(16)) + _A)
    # a chunk's key without component p: the sum of the other terms, marked with chunk and p
    return _mixed((terms.sum(-1, keepdims=True) - terms) ^ (place * _B)).reshape(-1, N_HASHES).view(np.int64)


def _first_shared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Number of the first key that a signature has in common with each of the others."""
    differ = (others != one).reshape(-1, N_CHUNKS, CHUNK)
    chunk = (differ.sum(-1) <= 1).argmax(1)
    return chunk * CHUNK + differ[np.arange(len(differ)), chunk].argmax(1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 2000):
            batch = whole.slice(lo, 2000)
            keys = _keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, N_HASHES))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), N_HASHES))], ["key", "rep"])


def _linked(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    last, own = None, None
    for batch in batches:
        rows = []
        for a, b, text_a, text_b in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if a != last:
                last, own = a, shingle_set(text_a, words)
            other = shingle_set(text_b, words)
            if 100 * min(len(own), len(other)) < percent * max(len(own), len(other)):
                continue
            both = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * both >= percent * (len(own) + len(other) - both) > 0:
                rows.append((a, b))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b"])


def _near_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of different components in a cell whose sketches are near, nearest first; each in the first key they share only."""
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, N_SKETCH // 4)
    ids, component, side = (table.column(c).to_numpy() for c in ("rep", "component", "side"))
    sizes = table.column("n_shingles").to_numpy()
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, N_HASHES)
    here = int(np.flatnonzero(_keys(signatures[:1])[0] == table.column("key")[0].as_py())[0])
    ones, others, distances = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(len(ids)):
        # a diagonal cell holds one side only; others compare side 0 with side 1
        other = np.flatnonzero((component != component[i]) & ((side == 2) & (ids > ids[i]) if side[i] == 2 else (side == 1) & (side[i] == 0)))
        other = other[5 * np.minimum(sizes[other], sizes[i]) >= 4 * np.maximum(sizes[other], sizes[i])] if len(other) else other
        if not len(other):
            continue
        distance = _FIELDS[sketches[other] ^ sketches[i]].sum(1, dtype=np.int64)
        other, distance = other[distance <= LOOSE * N_SKETCH], distance[distance <= LOOSE * N_SKETCH]
        first = _first_shared(signatures[i], signatures[other]) == here
        ones.append(np.full(int(first.sum()), i))
        others.append(other[first])
        distances.append(distance[first])
    by_distance = np.argsort(np.concatenate(distances), kind="stable")
    return np.concatenate(ones)[by_distance], np.concatenate(others)[by_distance]


def _in_question(table: pa.Table) -> pa.Table:
    """The members of a cell that are near one of another component."""
    ones, others = _near_pairs(table)
    return table.take(pa.array(np.unique(np.concatenate([ones, others]))))


def _settled(table: pa.Table, percent: int) -> pa.Table:
    """Links that join the components of a cell, one fewer than the components they join, confirmed on the full sets."""
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    ids, component = table.column("rep").to_pylist(), table.column("component").to_pylist()
    parent = {c: c for c in component}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    for i, j in zip(*(p.tolist() for p in _near_pairs(table))):
        a, b = root(component[i]), root(component[j])
        if a == b:
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            parent[b] = a
            links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pa.table({c: pa.array([link[k] for link in links], pa.int64()) for k, c in enumerate("ab")})


def _shingled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["rep", "shingles"])


def near_duplicate_components(docs: DataFrame, words: int = 5, percent: int = 80, rounds: int = 2, id_col: str = "doc_id",
                              text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Two texts are linked when 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the least id reachable over links.  Words are lower-cased in A-Z and split
    at ASCII white space.  Signatures have 98 components of 16 bits in 14 chunks of 7: every pair that
    differs in at most 27 components is a candidate; at similarity 0.8, where 20 differ on average,
    a pair is missed with a chance of 6 in a million.  ``percent`` below 80 needs other constants.

    A null, empty or blank text has no shingles and is linked with nothing.  Rows without id take part in
    no link; their component is null and they are kept.  Rows that repeat an id are one node and should repeat its text.  An
    empty table gives no rows; other columns are ignored.
    """
    if percent < 80:
        raise ValueError("the signature's chunks are laid out for 80 per cent and more")
    wanted = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    described = written(
        wanted.mapInArrow(lambda it: _described(it, words), "doc_id long, n_shingles long, set_id binary, signature binary"), "signatures")
    classes = written(
        described.where("n_shingles > 0 and doc_id is not null").groupBy("set_id")
        .agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("signature").alias("signature")), "classes")

    # keys are made anew for each use, which costs less than to store them
    keys = classes.select("rep", "signature").mapInArrow(_keyed, "key long, rep long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    members = written(keys.join(shared, "key"), "members")

    involved = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(wanted.join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "candidate-texts")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        ends = [texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
        with_texts = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "text_a", "text_b")
        return written(with_texts.mapInArrow(lambda it: _linked(it, words, percent), "a long, b long"), name)

    nodes = classes.select("rep")
    tested = links = component = None
    residual = members
    for step in range(rounds):
        # four orders of the classes give a class several leaders, so that one unlike leader does no harm
        if step == 0:
            rank = F.struct(F.xxhash64(F.col("rep"), F.pmod(F.col("key"), F.lit(4))), F.col("rep"))
        else:
            # those that meet most classes of their keys
            company = residual.groupBy("rep").agg(F.sum("_n").alias("_company"))
            residual = residual.join(company, "rep")
            rank = F.struct(-F.col("_company"), F.xxhash64(F.col("rep"), F.lit(step)), F.col("rep"))
        leaders = residual.groupBy("key").agg(F.min(rank).alias("_l")).select("key", F.col("_l.rep").alias("leader"))
        pairs = residual.join(leaders, "key").where("rep != leader").select(
            F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
            ends = [component.select(F.col("rep").alias(c), F.col("component").alias(f"_{c}")) for c in "ab"]
            pairs = pairs.join(ends[0], "a").join(ends[1], "b").where("_a != _b").select("a", "b")
        pairs = written(pairs, f"pairs-{step}")
        found = confirmed(pairs, f"links-{step}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        component = written(connected_components(nodes, links, "rep", "a", "b"), f"components-{step}")
        labelled = residual.select("key", "rep").join(component, "rep")
        mixed = labelled.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("_n"))
        residual = written(labelled.join(mixed.where("_lo != _hi").select("key", "_n"), "key"), f"residual-{step}")

    # what is left: classes of one key in different components, compared by longer sketches in cells
    open_texts = texts.join(residual.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sketches = written(open_texts.mapInArrow(lambda it: _sketched(it, words), "rep long, n_shingles long, sketch binary"), "sketches")
    parts = F.ceil(F.col("_n") / _CELL).cast("int")
    own = F.pmod(F.xxhash64("rep"), parts).cast("int")
    cells = (
        residual.join(sketches, "rep").join(classes.select("rep", "signature"), "rep")
        .withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("key", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "rep", "component", "n_shingles", "sketch", "signature",
                F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"))
    )
    question = written(cells.groupBy("key", "_i", "_j").applyInArrow(_in_question, cells.schema), "in-question")
    doubted = texts.join(question.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = doubted.mapInArrow(lambda it: _shingled(it, words), "rep long, shingles binary")
    last = question.join(sets, "rep").groupBy("key", "_i", "_j").applyInArrow(lambda t: _settled(t, percent), "a long, b long")
    links = links.unionByName(written(last, "links-last"))
    component = connected_components(nodes, links, "rep", "a", "b")

    by_set = classes.select("set_id", "rep").join(component, "rep").select("set_id", F.col("component").alias("_component"))
    rows = described.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id"))
    return rows.join(by_set, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
