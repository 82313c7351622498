"""Periodic runs of words by maximal pairs over an LCP-interval tree.

The suffixes of a text are sorted by prefix doubling, refining only the groups that are still
undecided, and the common prefixes of neighbours are read off the rounds' ranks.  The LCP-interval tree is
walked bottom up.  An interval holds its suffixes in lists by the word to their left; where two
children meet, pairs with different left words are maximal.  A pair of distance d and common
prefix l with d + l >= ``times`` * d covers a stretch of period d that no neighbouring word
extends, so such pairs are exactly the runs and nothing is extended afterwards.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words of the texts that are sorted together; a longer text is sorted alone.
_TOGETHER = 1 << 16


class _Numbers(dict):
    """A number from 1 on for every word."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self) + 1
        return value


def _suffix_order(words: np.ndarray, text: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, text by text, and each one's common prefix with the one before.

    Prefixes under ``most`` words may be given as shorter than they are, as nothing looks at them.
    """
    n = len(words)
    width = int(words.max()).bit_length()
    size = max(1, min((64 - int(text[-1]).bit_length()) // width, most))
    key = text.astype(np.uint64)
    for step in range(size):
        after = np.zeros(n, np.uint64)
        after[: max(n - step, 0)] = words[step:]
        after[np.arange(n) + step >= end] = 0
        key = (key << np.uint64(width)) | after
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, key[order][1:] != key[order][:-1])
    first = np.flatnonzero(fresh)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels = [(size, rank)]
    open_ = order[np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n)))]
    while len(open_):
        there = open_ + size
        inside = there < end[open_]
        second = np.where(inside, rank[np.where(inside, there, 0)].astype(np.int64) + 1, 0)
        own = rank[open_].astype(np.int64)
        key = own * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        open_, key, own = open_[by_key], key[by_key], own[by_key]
        at = np.arange(len(open_))
        group = np.append(True, own[1:] != own[:-1])
        fresh = np.append(True, key[1:] != key[:-1])
        place = own + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[open_] = place
        size *= 2
        levels.append((size, rank))
        first = np.flatnonzero(fresh)
        counts = np.diff(np.append(first, len(open_)))
        open_ = open_[np.repeat(counts > 1, counts)]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    common = np.zeros(n, np.int64)
    size, rank = levels[0]
    pair = np.flatnonzero(rank[order[1:]] == rank[order[:-1]]) + 1
    a, b = order[pair - 1], order[pair]
    stop = end[a]
    length = np.zeros(len(pair), np.int64)
    for size, rank in reversed(levels):
        same = np.maximum(a, b) + length < stop
        same &= rank[np.where(same, a + length, 0)] == rank[np.where(same, b + length, 0)]
        length += size * same
    same = np.ones(len(pair), bool)
    for _ in range(levels[0][0] - 1):
        same &= np.maximum(a, b) + length < stop
        same &= words[np.where(same, a + length, 0)] == words[np.where(same, b + length, 0)]
        length += same
    common[pair] = length
    return order, common


class _Group:
    """The suffixes of an interval, in order of place and by left word."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, left: int):
        self.places, self.lists = [place], {left: [place]}

    def joined(self, other: "_Group", common: int, left: list[int], times: int, found: dict[tuple[int, int], int]) -> "_Group":
        """Both groups in one; puts the maximal pairs between them into ``found``: (start, length) to least distance."""
        big, small = (self, other) if len(self.places) >= len(other.places) else (other, self)
        reach = common // (times - 1)
        if reach:
            for place in small.places:
                own = left[place]
                lo, hi = bisect_left(big.places, place - reach), bisect_right(big.places, place + reach)
                if lo == hi:
                    continue
                if hi - lo <= len(big.lists):
                    near = [p for p in big.places[lo:hi] if left[p] != own]
                else:
                    near = [p for word, places in big.lists.items() if word != own
                            for p in places[bisect_left(places, place - reach) : bisect_right(places, place + reach)]]
                for p in near:
                    distance = abs(p - place)
                    stretch = (min(p, place), distance + common)
                    if found.get(stretch, distance) >= distance:
                        found[stretch] = distance
        if len(small.places) <= 8:
            for place in small.places:
                insort(big.places, place)
                places = big.lists.setdefault(left[place], [])
                insort(places, place)
        else:
            big.places = sorted(big.places + small.places)
            for word, places in small.lists.items():
                big.lists[word] = sorted(big.lists.get(word, []) + places)
        return big


def _walk(places: list[int], common: list[int], left: list[int], times: int, found: dict[tuple[int, int], int]) -> None:
    """Bottom-up walk of the LCP-interval tree over consecutive suffixes; ``common[0]`` does not count."""
    stack: list[tuple[int, _Group]] = []
    child = _Group(places[0], left[places[0]])
    for place, shared in zip(places[1:], common[1:]):
        while stack and stack[-1][0] > shared:
            depth, group = stack.pop()
            child = group.joined(child, depth, left, times, found)
        if stack and stack[-1][0] == shared:
            depth, group = stack.pop()
            child = group.joined(child, depth, left, times, found)
        stack.append((shared, child))
        child = _Group(place, left[place])
    while stack:
        depth, group = stack.pop()
        child = group.joined(child, depth, left, times, found)


def runs_of(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    numbers = _Numbers()
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    text, end = np.repeat(np.arange(len(texts)), sizes), np.repeat(ends, sizes)
    # a run of period 1 has least - 1 words in common with itself one word on, longer periods (times - 1) a word or more
    fewest = min(max((times - 1) * d, least - d) for d in range(1, least + 1))
    order, common = _suffix_order(words, text, end, fewest)
    # suffixes that share enough words with a neighbour, in stretches of neighbours
    linked = common >= fewest
    inside = linked | np.append(linked[1:], False)
    at = np.flatnonzero(inside)
    if not len(at):
        return out
    first = np.flatnonzero(~linked[at])
    stretch = np.cumsum(~linked[at]) - 1
    by_place = np.lexsort((order[at], stretch))
    gap = np.diff(order[at][by_place], prepend=0)
    gap[first] = np.iinfo(np.int64).max
    near = np.minimum.reduceat(gap, first) <= np.maximum.reduceat(np.where(linked[at], common[at], 0), first) // (times - 1)
    starts = ends - sizes
    left = np.append(0, words[:-1])
    left[starts[sizes > 0]] = 0
    before, found = left.tolist(), {}
    bounds = np.append(first, len(at))
    for k in np.flatnonzero(near).tolist():
        part = at[bounds[k] : bounds[k + 1]]
        _walk(order[part].tolist(), common[part].tolist(), before, times, found)
    for (start, length), period in found.items():
        if length >= least:
            which = int(text[start])
            out[which].append((start - int(starts[which]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words).decode()


def _found(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        lo = 0
        while lo < rows:
            texts, total, hi = [], 0, lo
            while hi < rows and (total < _TOGETHER or not texts):
                value = batch.column(1)[hi].as_py()
                # bytes.split knows ASCII white space only
                texts.append((value or "").encode().split())
                total += len(texts[-1])
                hi += 1
            runs = runs_of(texts, least, times)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(_RUN)),
                 pa.array([_collapsed(t, r) for t, r in zip(texts, runs)], pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])
            lo = hi


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``docs``.

    Words are split at ASCII white space and numbered from 0.  ``runs`` holds (start, length, period) by
    start, then period: each stretch of at least ``least`` words and ``times`` smallest periods that no
    neighbouring word extends.  ``collapsed`` joins the words by one space without those that a run holds
    after its first period.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``.  Rows with null or repeated ids
    are judged one by one; an empty table gives no rows; other columns are ignored.  Texts are sorted in
    groups of 65,536 words, a longer one alone, with about 8 bytes a word for each doubling of its longest repeat.
    """
    if times < 2 or least < 2:
        raise ValueError("a run repeats its period at least once")
    wanted = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return wanted.mapInArrow(
        lambda it: _found(it, least, times),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
