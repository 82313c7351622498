"""Phrase mining by SON partitioning, and collocation scores of the phrases.

The texts are written once as blocks: the words of one language, numbered, with a bounded number of
words each.  The blocks are dealt to half as many shards as the support, whatever the input's size.  A phrase of
support s in a language of N words occurs at least s * n / N times in some shard of n words, so every
shard is mined completely at that lowered support, from single words up: a phrase can only be frequent
where both phrases one word shorter are.  The blocks of a shard give their phrases' hashes and counts;
each part of the hash space adds them up by shard, takes the locally frequent ones, and unites
those of all shards that together reach the support.  The candidates of a length form a bitmap of fixed size.
Last, all candidates are counted globally and exactly, as words; what the hashes let through by
chance falls there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.store import written

#: Words of a block; a task holds twice as many.
BLOCK_WORDS = 1_000_000
#: Bits of the candidate bitmap of one length: 8 MB, whatever the input's size.
BITS = 26
#: Languages share so many totals of words; a total of several languages only lowers the support further.
_TOTALS = 64
#: Distinct phrases of a block are dealt to parts of about so many words of the whole input.
_PART_WORDS = 2_000_000
_SALTS = 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_STOPS = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_BLOCK = "lang string, total int, shard int, n long, words binary, ids binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return (x ^ (x >> np.uint64(29))) * _B


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


class _Vocabulary(dict):
    """Numbers of the words of a block: 0 ends a piece, -1 stands for no word."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) - 1
        return value


class _Block:
    def __init__(self) -> None:
        self.numbers = _Vocabulary({b"": -1, b"\n": 0})
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, text: str) -> int:
        pieces = (text.encode().lower().translate(_STOPS).replace(b"\n", b" \n ") + b" \n").split(b" ")
        ids = np.fromiter(map(self.numbers.__getitem__, pieces), np.int32, len(pieces))
        ids = ids[ids >= 0]
        words = int(np.count_nonzero(ids))
        if words:
            # one piece end after another says nothing
            self.parts.append(ids[(ids > 0) | np.append(True, ids[:-1] > 0)])
            self.n += words
        return words

    def row(self, lang: str, shards: int) -> tuple:
        # words in byte order, so that phrases in the order of their numbers are nearly sorted
        words = sorted(w for w, i in self.numbers.items() if i > 0)
        place = np.zeros(len(words) + 1, np.int64)
        place[[self.numbers[w] for w in words]] = np.arange(1, len(words) + 1)
        ids = place[np.concatenate(self.parts)].astype("<i4").tobytes()
        return lang, _hash(lang) % _TOTALS, xxhash.xxh64_intdigest(ids) % shards, self.n, b"\n".join(words), ids


def _row(row: tuple) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = [part.split()[0] for part in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types)], names)


def _blocks(batches: Iterator[pa.RecordBatch], most: int, shards: int) -> Iterator[pa.RecordBatch]:
    open_: dict[str, _Block] = {}
    held = 0

    def closed(lang: str) -> pa.RecordBatch:
        nonlocal held
        block = open_.pop(lang)
        held -= block.n
        return _row(block.row(lang, shards))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lang = "und" if lang is None else lang
            if lang not in open_:
                open_[lang] = _Block()
            held += open_[lang].add(text or "")
            if open_[lang].n >= most:
                yield closed(lang)
            elif held >= 2 * most:
                yield closed(max(open_, key=lambda k: open_[k].n))
    for lang in sorted(open_):
        if open_[lang].n:
            yield closed(lang)


class _Read:
    """A block's words and numbers, with the hash of every window of its ids."""

    def __init__(self, row: dict):
        self.words = row["words"].split(b"\n") if row["words"] else []
        self.ids = np.frombuffer(row["ids"], "<i4").astype(np.int64)
        seed = _hash(row["lang"])
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed & 0xFFFFFFFFFFFFFFFF) for w in self.words), np.uint64, len(self.words))
        self._of_word = _mixed(np.append(np.uint64(0), hashes))

    def windows(self, size: int) -> np.ndarray:
        """Hash of the phrase of ``size`` words from each place on; those over a piece's end mean nothing."""
        n = len(self.ids) - size + 1
        out = np.full(max(n, 0), size, np.uint64)
        if n > 0:
            own = self._of_word[self.ids]
            for i in range(size):
                out = _mixed(out + own[i : i + n])
        return out

    def places(self, size: int, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Places, and hashes, of the phrases of ``size`` words within pieces, both of whose shorter phrases are ``known``."""
        n = len(self.ids) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        good = np.ones(n, bool)
        for i in range(size):
            good &= self.ids[i : i + n] > 0
        if known is not None:
            shorter = _has(known, self.windows(size - 1))
            good &= shorter[:n] & shorter[1 : n + 1]
        at = np.flatnonzero(good)
        out = np.full(len(at), size, np.uint64)
        for i in range(size):
            out = _mixed(out + self._of_word[self.ids[at + i]])
        return at, out


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITS)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _support(n: int, total: int, support: int) -> int:
    """The lowered support: the least whole number that is support * n / total or more."""
    return max(1, -(-support * n // max(total, 1)))


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte, first bytes first: the high ones are mostly zeros, which shuffles compress."""
    data = values.astype(kind)
    return np.ascontiguousarray(data.view(np.uint8).reshape(-1, data.itemsize).T).tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1).astype(np.int64)


def _mined(batches: Iterator[pa.RecordBatch], size: int, support: int, bits: int, parts: int, known) -> Iterator[pa.RecordBatch]:
    """Of each block and part of the hash space: the first ``bits`` bits of the phrases' hashes, as sorted differences, and their counts."""
    known = None if known is None else np.frombuffer(known.value, np.uint8)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            codes = np.sort(_Read(row).places(size, known)[1] >> np.uint64(64 - bits)).astype(np.int64)
            if not len(codes):
                continue
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            counts = np.minimum(np.diff(np.append(first, len(codes))), support)
            codes = codes[first]
            part = ((codes >> (bits - BITS)) * parts) >> BITS
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(first[1:], len(part))
            step = np.diff(codes, prepend=0)
            step[first] = codes[first] - (-(-(part[first] << BITS) // parts) << (bits - BITS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[first]), pa.array([row["total"]] * len(first), pa.int32()), pa.array([row["shard"]] * len(first), pa.int32()),
                 pa.array([_planes(step[a:b], "<u4") for a, b in zip(first, ends)], pa.binary()),
                 pa.array([_planes(counts[a:b], "<u4") for a, b in zip(first, ends)], pa.binary())],
                ["part", "total", "shard", "steps", "counts"])


def _united(table: pa.Table, support: int, bits: int, parts: int, least: dict[tuple[int, int], int]) -> pa.Table:
    """The piece of the candidate bitmap that a part of the hash space makes."""
    part = table.column("part")[0].as_py()
    # the least and the greatest bit that fall to this part
    low, high = -(-(part << BITS) // parts), -(-((part + 1) << BITS) // parts)
    found = np.zeros(((high + 7) // 8 - low // 8) * 8, bool)
    for total in set(table.column("total").to_pylist()):
        own = table.filter(pc.equal(table.column("total"), total))
        blocks = [np.cumsum(_numbers(b, "<u4")) for b in own.column("steps").to_pylist()]
        codes = np.concatenate(blocks)
        shard = np.repeat(own.column("shard").to_numpy(), [len(b) for b in blocks])
        counts = np.concatenate([_numbers(b, "<u4") for b in own.column("counts").to_pylist()])
        order = np.lexsort((shard, codes))
        codes, shard, counts = codes[order], shard[order], counts[order]
        fresh = np.append(True, codes[1:] != codes[:-1])
        first = np.flatnonzero(fresh | np.append(True, shard[1:] != shard[:-1]))
        local = np.add.reduceat(counts, first)
        frequent = local >= np.array([least[total, s] for s in range(max(shard) + 1)])[shard[first]]
        phrase = np.flatnonzero(fresh[first])
        kept = np.logical_or.reduceat(frequent, phrase) & (np.add.reduceat(local, phrase) >= support)
        found[(codes[first[phrase[kept]]] >> (bits - BITS)) + low - low // 8 * 8] = True
    return pa.table({"first": pa.array([low // 8], pa.int64()), "bits": pa.array([np.packbits(found, bitorder="little").tobytes()], pa.binary())})


def _counted(batches: Iterator[pa.RecordBatch], longest: int, parts: int, known: list) -> Iterator[pa.RecordBatch]:
    """Of each block and part of the hash space: the candidates of every length as the words themselves, and their counts."""
    maps = [np.frombuffer(k.value, np.uint8) for k in known]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = _Read(row)
            words = pa.array(block.words, pa.binary())
            for size in range(1, longest + 1):
                at, hashes = block.places(size, maps[size - 2] if size > 1 else None)
                good = _has(maps[size - 1], hashes)
                at, hashes = at[good], hashes[good]
                if not len(at):
                    continue
                # phrases by their words' numbers, one word more at a time
                code = block.ids[at]
                for step in range(1, size):
                    _, code = np.unique(code, return_inverse=True)
                    code = code * (len(block.words) + 1) + block.ids[at + step]
                _, first, counts = np.unique(code, return_index=True, return_counts=True)
                part = ((hashes[first] >> np.uint64(64 - BITS)).astype(np.int64) * parts) >> BITS
                by_part = np.argsort(part, kind="stable")
                start, part, counts = at[first][by_part], part[by_part], counts[by_part]
                columns = [words.take(pa.array(block.ids[start + step] - 1)) for step in range(size)]
                phrase = columns[0] if size == 1 else pc.binary_join_element_wise(*columns, b" ")
                bounds = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
                k = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[bounds[:-1]]), pa.array([row["lang"]] * k, pa.string()),
                     pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), phrase), b"\n"),
                     pa.array([_planes(counts[a:b], "<u4") for a, b in zip(bounds, bounds[1:])], pa.binary())],
                    ["part", "lang", "phrases", "counts"])


def _added(table: pa.Table, support: int) -> pa.Table:
    """(lang, phrase, f) of the phrases of a part of the hash space that are frequent over all blocks."""
    found = [p.split(b"\n") for p in table.column("phrases").to_pylist()]
    sizes = [len(p) for p in found]
    lang = np.repeat(np.arange(len(sizes)), sizes)
    names = table.column("lang").combine_chunks().dictionary_encode()
    rows = pa.table({"lang": pa.array(names.indices.to_numpy()[lang]), "phrase": pa.array([p for own in found for p in own], pa.binary()),
                     "f": pa.array(np.concatenate([_numbers(c, "<u4") for c in table.column("counts").to_pylist()]))})
    sums = rows.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
    sums = sums.filter(pc.greater_equal(sums.column("f_sum"), support))
    return pa.table({"lang": names.dictionary.take(sums.column("lang").combine_chunks()), "phrase": sums.column("phrase").cast(pa.string()), "f": sums.column("f_sum")})


def frequent_phrases(docs: DataFrame, support: int = 30, longest: int = 4, text_col: str = "text", lang_col: str = "lang",
                     block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of 1 to ``longest`` words found ``support`` times or more, and (lang, n) words.

    Texts are lower-cased in A-Z and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks and tabs;
    phrases lie within a piece, overlapping occurrences count.  A null language is ``und``.  Null and
    empty texts have no words; a language without words is in neither result; repeated rows count each time;
    an empty table gives no rows; other columns are ignored.

    Blocks, parts and the lowered support follow the same rule at every size; memory does not grow with the input.
    """
    spark = docs.sparkSession
    wanted = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text"))
    shards = max(1, support // 2)
    rows = wanted.mapInArrow(lambda it: _blocks(it, block_words, shards), _BLOCK)
    # few blocks a file, as a reader takes several rows of a file at a time
    blocks = written(rows, "blocks", maxRecordsPerFile=4)
    held = {(total, shard): n for total, shard, n in blocks.groupBy("total", "shard").agg(F.sum("n")).collect()}
    totals: dict[int, int] = {}
    for (total, _), n in held.items():
        totals[total] = totals.get(total, 0) + n
    least = {(t, s): _support(held.get((t, s), 0), totals[t], support) for t in totals for s in range(shards)}
    words = sum(totals.values())
    parts = min(max(spark.sparkContext.defaultParallelism, math.ceil(words / _PART_WORDS)), 1 << (BITS - 3))
    # enough bits that few phrases share a code; a part's differences of codes stay under 2 ** 32
    bits = min(max(words.bit_length() + 6, BITS), 48)

    known: list = []
    for size in range(1, longest + 1):
        before = known[-1] if known else None
        mined = blocks.mapInArrow(lambda it, size=size, before=before: _mined(it, size, support, bits, parts, before),
                                  "part long, total int, shard int, steps binary, counts binary")
        pieces = mined.groupBy("part").applyInArrow(lambda t: _united(t, support, bits, parts, least), "first long, bits binary")
        bitmap = np.zeros((1 << BITS) // 8 + 8, np.uint8)
        for first, piece in pieces.collect():
            piece = np.frombuffer(piece, np.uint8)
            bitmap[first : first + len(piece)] |= piece
        known.append(spark.sparkContext.broadcast(bitmap.tobytes()))

    counted = blocks.mapInArrow(lambda it: _counted(it, longest, parts, known), "part long, lang string, phrases binary, counts binary")
    exact = counted.groupBy("part").applyInArrow(lambda t: _added(t, support), "lang string, phrase string, f long")
    exact = exact.select("lang", F.size(F.split("phrase", " ")).alias("size"), "phrase", "f")
    return written(exact, "phrases"), blocks.groupBy("lang").agg(F.sum("n").alias("n"))


def _words(phrase: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def collocations(docs: DataFrame, support: int = 30, longest: int = 4, top: int = 2000, covered: int = 80, scale: int = 2_000_000,
                 text_col: str = "text", lang_col: str = "lang", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words by score.

    A phrase found a times, cut in two parts found l and r times, scores floor(scale * a / (l + r)); its
    lowest cut counts, of equals the first.  A phrase within a longer one found at least ``covered`` per cent as often is left out.
    Ranks go by score, then a, both descending, then phrase in byte order.  Odd rows are as in :func:`frequent_phrases`.
    """
    phrases, words = frequent_phrases(docs, support, longest, text_col, lang_col, block_words)
    candidates = phrases.where("size > 1").withColumnRenamed("f", "a")
    cuts = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _words(F.col("phrase"), F.lit(1), F.col("k")), "right": _words(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k"))})
    # a common word begins or ends very many phrases: single words are dealt to several places
    salts = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    parts = phrases.select("lang", "phrase", "f", F.explode(salts).alias("salt"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).cast("int")
    cuts = cuts.withColumns({"salt_l": F.when(F.col("k") == 1, salt).otherwise(0), "salt_r": F.when(F.col("size") - F.col("k") == 1, salt).otherwise(0)})
    ends = [parts.select("lang", F.col("phrase").alias(side), F.col("salt").alias(f"salt_{name}"), F.col("f").alias(name))
            for side, name in (("left", "l"), ("right", "r"))]
    both = cuts.join(ends[0], ["lang", "left", "salt_l"]).join(ends[1], ["lang", "right", "salt_r"])
    score = F.expr(f"CAST(CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + r) AS BIGINT)")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))

    longer = candidates.where("size > 2").select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
    inner = longer.select("lang", "a", F.col("phrase").alias("_long"), "size", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("_at"))
    most = inner.groupBy("lang", _words(F.col("_long"), F.col("_at"), F.col("k")).alias("phrase")).agg(F.max("a").alias("_most"))
    left = scored.join(most, ["lang", "phrase"], "left").where(
        F.col("_most").isNull() | (F.col("_most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered))

    order = Window.partitionBy("lang").orderBy(F.desc("_c.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("_c.l").alias("l"), F.col("_c.r").alias("r"), "n", F.col("_c.score").alias("score"))


#: The same result from all counts, without shards or candidates.
COLLOCATIONS_SQL = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (VALUES (1), (2), (3), (4)) AS s(size)
  WHERE i + size - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
u AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : ], ' ')),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (
  SELECT lang, array_to_string(w[s : s + k - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS k FROM c WHERE size > 2))
  GROUP BY 1, 2),
d AS (
  SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.most IS NULL OR 100 * i.most < 80 * b.a),
e AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT e.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(t.n AS BIGINT) AS n, score
FROM e JOIN t ON t.lang = e.lang WHERE rank <= 2000
"""
