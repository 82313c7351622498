"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents become token ids plus an end id.  Whole windows are cut off a document first; the
rest is cut into pieces of at most ``piece`` ids.  A batch of pieces is dealt to windows by
multiway differencing: the two partial partitions of the largest imbalance are merged so that
the heavy windows of one meet the light windows of the other, until one partition is left.
The window count starts at the least possible and rises while a window exceeds the capacity.
Batches stay inside a task, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkloom.llm.wordcache import cache_for, slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(name, pa.int64()) for name in
                    ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _differencing(weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, window sums) from merging partial partitions of ``k`` windows."""
    n = len(weights)
    parent = np.arange(n)
    state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = [(-int(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)

    def opened(i: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums in falling order, and a member of each window (-1: none)."""
        if i in state:
            return state.pop(i)
        sums, member = np.zeros(k, np.int64), np.full(k, -1)
        sums[0], member[0] = weights[i], i
        return sums, member

    fresh = n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sa, ma), (sb, mb) = opened(a), opened(b)
        sums, other = sa + sb[::-1], mb[::-1]
        both = (ma >= 0) & (other >= 0)
        parent[other[both]] = ma[both]
        member = np.where(ma >= 0, ma, other)
        order = np.argsort(-sums, kind="stable")
        sums, member = sums[order], member[order]
        sums = sums - sums[-1]
        state[fresh] = (sums, member)
        heapq.heappush(heap, (-int(sums[0]), fresh))
        fresh += 1
    _, member = opened(heap[0][1])
    # members point to the member they were merged under; later merges only lengthen the chain
    root = parent
    while True:
        above = root[root]
        if np.array_equal(above, root):
            break
        root = above
    window_of = np.full(n, -1)
    used = member[member >= 0]
    window_of[used] = np.arange(len(used))
    bins = window_of[root]
    return bins, np.bincount(bins, weights=weights, minlength=k).astype(np.int64)


def differencing_windows(weights: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each item; weights are 1..capacity, no window exceeds ``capacity``."""
    if not len(weights):
        return np.empty(0, np.int64)
    k = max(1, -(-int(weights.sum()) // capacity))
    while k < len(weights):
        bins, sums = _differencing(weights, k)
        if sums.max() <= capacity:
            return bins
        k += 1
    return np.arange(len(weights))


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, piece: int, batch_items: int,
            part_bits: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    cache, base = cache_for(path), TaskContext.get().partitionId() << part_bits
    sequence = 0
    waiting: list[tuple] = []  # (doc_id, start, length, crc, doc_tokens)
    rows: list[tuple] = []

    def settle() -> None:
        nonlocal sequence
        bins = differencing_windows(np.array([w[2] for w in waiting], np.int64), capacity)
        filled: dict[int, list] = {}
        for item, window in zip(waiting, bins.tolist()):
            number, used = filled.setdefault(window, [sequence + len(filled), 0])
            rows.append((*item, base + number, used))
            filled[window][1] = used + item[2]
        sequence += len(filled)
        waiting.clear()

    def flushed() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ARROW)
        rows.clear()
        return made

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in slices(texts):
            flat, counts = cache.encode(texts[lo:hi])
            at = 0
            for doc, count in zip(ids[lo:hi], counts.tolist()):
                own = np.append(flat[at : at + count], np.uint32(end_id)).astype("<u4")
                at += count
                total = count + 1
                start = 0
                while start < total:
                    length = capacity if total - start >= capacity else min(piece, total - start)
                    crc = zlib.crc32(own[start : start + length].tobytes())
                    if length == capacity:
                        rows.append((doc, start, length, crc, total, base + sequence, 0))
                        sequence += 1
                    else:
                        waiting.append((doc, start, length, crc, total))
                    start += length
                if len(waiting) >= batch_items:
                    settle()
            if len(rows) >= 20_000:
                yield flushed()
    settle()
    if rows:
        yield flushed()


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 1024, piece: int = 256,
                   batch_items: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document in a sequence of at most ``capacity`` ids.

    Columns: see ``PIECES``; ``start`` and ``doc_tokens`` count the document's ids with the end
    id, ``offset`` is the place in the sequence.  Sequence ids are unique, not dense.  A null or
    empty text is its end id alone; a null document id is packed like any other; repeated rows
    are packed each; an empty table gives no rows; other columns are ignored.  ``batch_items``
    pieces are balanced together, which bounds a task's memory; pieces of one batch may come
    from any documents of the partition.
    """
    if not 1 <= piece <= capacity:
        raise ValueError("piece must lie between 1 and capacity")
    wanted = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return wanted.mapInArrow(
        lambda it: _packed(it, tokenizer_path, end_id, capacity, piece, batch_items, 33), PIECES)
