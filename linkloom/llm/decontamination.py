"""Benchmark decontamination by the q-gram lemma.

A text region within ``e`` edits of a benchmark segment of m characters shares at least
m - q + 1 - q * e of its q-grams with it, all on diagonals that lie within ``e`` of each other.
Shared q-grams are counted in overlapping diagonal bands; bands that reach the bound are verified
by a banded alignment.  Documents are scanned where they lie; the benchmark goes to the tasks in
blocks of a fixed size, one pass over the documents each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_A, _B, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the ``q`` characters from each place on."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    powers = {1: (codes.astype(np.uint64) + np.uint64(1)) * _MIX}
    size = 1
    while 2 * size <= q:
        half = powers[size]
        powers[2 * size] = (half[:-size] * _A ^ (half[:-size] >> np.uint64(29))) + half[size:]
        size *= 2
    out, done = powers[size], size
    while done < q:
        part = max(p for p in powers if p <= q - done)
        keep = len(codes) - done - part + 1
        out = (out[:keep] * _B ^ (out[:keep] >> np.uint64(31))) + powers[part][done : done + keep]
        done += part
    return (out ^ (out >> np.uint64(32))) * _MIX


class _Index:
    """Segments of a block of benchmark items and the places of their q-grams."""

    def __init__(self, items: list[tuple], q: int, edit_rate: float, segment: int):
        self.q = q
        self.item, self.codes, self.edits, self.bound = [], [], [], []
        for item, text in items:
            codes = _codes(normal(text))
            if len(codes) < q:
                continue
            if len(codes) <= segment * 3 // 2:
                starts, size = [0], len(codes)
            else:
                size = segment
                starts = sorted({*range(0, len(codes) - size, size // 2), len(codes) - size})
            for start in starts:
                # the bound must ask for one shared q-gram at least
                edits = min(int(edit_rate * size), (size - q) // q)
                self.item.append(item)
                self.codes.append(codes[start : start + size])
                self.edits.append(edits)
                self.bound.append(size - q + 1 - q * edits)
        grams = [_gram_hashes(c, q) for c in self.codes]
        hashes = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.hashes, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.edits, self.bound = np.array(self.edits, np.int64), np.array(self.bound, np.int64)
        self.longest = max((len(c) for c in self.codes), default=0)

    def candidates(self, codes: np.ndarray, positions: int = 1 << 20, postings: int = 1 << 20) -> Iterator[np.ndarray]:
        """(segment, band) pairs whose overlapping diagonal band reaches the segment's bound, in several arrays.

        The text is read in windows of ``positions`` and its shared grams in steps of about ``postings``.  A band is
        closed as soon as no later place can lie in it, so periodic texts and items take no more memory than others.
        """
        if not len(self.hashes):
            return
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for base in range(0, max(len(codes) - self.q + 1, 0), positions):
            hashes = _gram_hashes(codes[base : base + positions + self.q - 1], self.q)
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            found = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
            same = self.hashes[found] == hashes[at]
            at, found = at[same] + base, found[same]
            # each step starts at the first place whose postings pass a multiple of the step's size
            total = np.cumsum(self.count[found])
            steps = np.flatnonzero(np.diff(total // postings, prepend=0)) if len(at) else np.empty(0, np.int64)
            edges = np.unique(np.concatenate([[0], steps, [len(at)]]))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                keys, counts = self._counted(at[lo:hi], found[lo:hi], keys, counts)
                upcoming = int(at[hi]) if hi < len(at) else base + positions
                segment, band = self._unpacked(keys)
                closed = (band + 2) * (self.edits[segment] + 1) - 1 < upcoming - self.longest
                enough = closed & (counts >= self.bound[segment])
                yield np.stack([segment[enough], band[enough]], 1)
                keys, counts = keys[~closed], counts[~closed]
        segment, band = self._unpacked(keys)
        enough = counts >= self.bound[segment]
        yield np.stack([segment[enough], band[enough]], 1)

    @staticmethod
    def _unpacked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return keys >> 40, (keys & ((1 << 40) - 1)) - (1 << 38)

    def _counted(self, at: np.ndarray, found: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``counts`` of the bands ``keys`` and of those that the grams ``found`` at places ``at`` lie in."""
        n = self.count[found]
        ends = np.cumsum(n)
        posting = np.repeat(self.first[found] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        segment = self.owner[posting]
        band = (np.repeat(at, n) - self.place[posting]) // (self.edits[segment] + 1)
        # bands are two widths wide and overlap by one, so any run of diagonals of one width lies in a band
        new, times = np.unique(np.concatenate([segment, segment]) * (1 << 40) + np.concatenate([band, band - 1]) + (1 << 38), return_counts=True)
        merged, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return merged, np.bincount(place, np.concatenate([counts, times]), len(merged)).astype(np.int64)

    def align(self, segment: int, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits, end) of the best match of the segment in each text ``joined[start:end]``, started on its diagonals low..high.

        Diagonals and ends count from the text's start; the ranges low..high are of one width, and the texts' ends are bounds too.
        """
        codes, edits = self.codes[segment], int(self.edits[segment])
        width = int(high[0] - low[0]) + 1 + 2 * edits
        steps = np.arange(width)
        far = len(codes) + 1
        best, end = [], []
        at_once = max(1, 400_000 // (len(codes) + width))
        for lo in range(0, len(low), at_once):
            part = slice(lo, lo + at_once)
            begin, size = starts[part, None], (ends - starts)[part, None]
            k = low[part, None] - edits + steps
            place = low[part, None] - edits + np.arange(len(codes) + width)
            inside = (place >= 0) & (place < size)
            letters = np.where(inside, joined[np.where(inside, place + begin, 0)] if len(joined) else 0, np.uint32(0xFFFFFFFF))
            row = np.where((k >= 0) & (k <= size), 0, far)
            for i, letter in enumerate(codes.tolist()):
                change = row + (letters[:, i : i + width] != letter)
                change[:, :-1] = np.minimum(change[:, :-1], row[:, 1:] + 1)
                change[:, -1] = np.minimum(change[:, -1], far + 1)
                row = np.minimum(change, np.minimum.accumulate(change - steps, 1) + steps)
            least = row.argmin(1)[:, None]
            best.append(np.take_along_axis(row, least, 1)[:, 0])
            end.append(np.take_along_axis(k, least, 1)[:, 0] + len(codes))
        return np.concatenate(best), np.concatenate(end)


def _matches(index: _Index, texts: list[str], settled: np.ndarray | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(text number, segment, edits, end) of every verified region, texts being normal.

    Texts that the caller marks in ``settled`` meanwhile are not looked at again.
    """
    joined = _codes("\n".join(texts))
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    sizes = np.diff(starts) - 1
    for found in index.candidates(joined):
        for segment in np.unique(found[:, 0]).tolist():
            width = int(index.edits[segment]) + 1
            low = found[found[:, 0] == segment, 1] * width
            high = low + 2 * width - 1
            # the text that holds the middle of the region, and its neighbours where the band reaches them
            first = np.maximum(np.searchsorted(starts, np.maximum(low, 0), "right") - 1, 0)
            reach = np.minimum(high + len(index.codes[segment]), int(starts[-1]) - 1)
            last = np.minimum(np.searchsorted(starts, reach, "right") - 1, len(texts) - 1)
            n = np.maximum(last - first + 1, 0)
            number = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            low, high = np.repeat(low, n), np.repeat(high, n)
            if settled is not None:
                open_ones = ~settled[number]
                number, low, high = number[open_ones], low[open_ones], high[open_ones]
            if not len(number):
                continue
            begin = starts[number]
            edits, end = index.align(segment, joined, begin, begin + sizes[number], low - begin, high - begin)
            for hit in np.flatnonzero(edits <= index.edits[segment]).tolist():
                yield int(number[hit]), segment, int(edits[hit]), int(end[hit])


_BUILT: dict[tuple, _Index] = {}


def _index_of(block, q: int, edit_rate: float, segment: int) -> _Index:
    """A worker builds the index of a block once."""
    name, items = block.value
    key = (name, q, edit_rate, segment)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = _Index(items, q, edit_rate, segment)
    return _BUILT[key]


def _slices(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int):
    """Broadcasts of (name, items) of the benchmark, ``block_chars`` characters each at most but for one longer item."""
    context = benchmark.sparkSession.sparkContext
    held, size = [], 0
    for item, text in benchmark.select(benchmark[id_col].cast("long"), text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        if held and size + len(text) > block_chars:
            yield context.broadcast((uuid.uuid4().hex, held))
            held, size = [], 0
        held.append((item, text))
        size += len(text)
    if held:
        yield context.broadcast((uuid.uuid4().hex, held))


def find_contamination(docs: DataFrame, benchmark: DataFrame, q: int = 12, edit_rate: float = 0.06, segment: int = 120,
                       block_chars: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, n_regions, last_end): documents that hold benchmark text, and which.

    Characters are compared in lower case with white space collapsed.  Items up to one and a half
    ``segment`` long are sought whole, longer ones in overlapping segments, so that a long part
    counts too.  A region may differ by ``edit_rate`` of the segment's length.  ``edits`` is that of
    the best region, ``last_end`` the place after the last one in the normalised text.

    Null texts and items, and items under ``q`` normalised characters, match nothing.  Repeated
    rows and ids fall together per (doc_id, item_id); a null id is one value.  Empty tables give
    no rows; other columns are ignored.
    """
    schema = "doc_id long, item_id long, edits long, n_regions long, last_end long"

    def scan(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(block, q, edit_rate, segment)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [normal(t) for t in batch.column(1).to_pylist()]
                rows: dict[tuple, list] = {}
                for lo, hi in _slices(texts):
                    for number, which, edits, end in _matches(index, texts[lo:hi]):
                        seen = rows.setdefault((lo + number, index.item[which]), [edits, {}])
                        seen[0] = min(seen[0], edits)
                        seen[1][(which, end)] = end
                if rows:
                    columns = zip(*((ids[n], item, e, len(ends), max(ends.values())) for (n, item), (e, ends) in rows.items()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                     ["doc_id", "item_id", "edits", "n_regions", "last_end"])
        return run

    wanted = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col, block_chars):
        found = found.unionByName(wanted.mapInArrow(scan(block), schema))
    return found.groupBy("doc_id", "item_id").agg(
        F.min("edits").alias("edits"), F.sum("n_regions").alias("n_regions"), F.max("last_end").alias("last_end"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, q: int = 12, edit_rate: float = 0.06, segment: int = 120,
                          block_chars: int = 4_000_000, text_col: str = "text", item_col: str = "item_id",
                          item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, all columns as they are.

    Cases are those of ``find_contamination``; rows are filtered where they lie, without a shuffle.
    """
    at = docs.columns.index(text_col)

    def scan(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index_of(block, q, edit_rate, segment)
            for batch in batches:
                texts = [normal(t) for t in batch.column(at).to_pylist()]
                clean = np.ones(len(texts), bool)
                for lo, hi in _slices(texts):
                    settled = np.zeros(hi - lo, bool)
                    for number, *_ in _matches(index, texts[lo:hi], settled):
                        settled[number] = True
                    clean[lo:hi] = ~settled
                yield batch.filter(pa.array(clean))
        return run

    for block in _blocks(benchmark, item_col, item_text_col, block_chars):
        docs = docs.mapInArrow(scan(block), docs.schema)
    return docs
