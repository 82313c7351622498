"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Round j inserts the suffix of length j of every string: its place follows from the ranks of the
symbols in the transform of the shorter suffixes, and its common prefixes with its neighbours are
one more than the least common prefix between the places it comes from.  Each round reads the
streams of the last round once, in order, and writes new ones.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a symbol at most: 1, 2, 4 or 8.
WIDEST = 8


def _symbols(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of ``width`` bytes, numbered from 1 in order, of every string from each of its first ``width`` bytes on; their counts."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(sizes)
    value, bits = data.astype(np.uint64 if width == 8 else np.uint32 if width == 4 else np.uint16), 8
    while bits < 8 * width:
        value, bits = (value[: -(bits // 8)] << bits) | value[bits // 8 :], 2 * bits
    counts = np.stack([np.maximum(sizes - phase, 0) // width for phase in range(width)], 1).reshape(-1)
    first = ((ends - sizes)[:, None] + np.arange(width)).reshape(-1)
    at = np.repeat(first - width * (np.cumsum(counts) - counts), counts) + width * np.arange(int(counts.sum()))
    text = value[at]
    if width > 2:
        seen, number = np.unique(text, return_inverse=True)
        return (number + 1).astype(np.uint16 if len(seen) + 1 < 1 << 16 else np.uint32), counts
    seen = np.zeros(1 << 16, bool)
    seen[text] = True
    number = np.cumsum(seen)
    # 0 ends a string, so all 65,536 pairs need wider numbers
    return number[text].astype(np.uint16 if number[-1] < 1 << 16 else np.uint32), counts


def repeated_starts(strings: list[bytes], length: int, widest: int = WIDEST) -> np.ndarray:
    """Codes ``number << 32 | start`` of the places where a substring of ``length`` bytes begins that begins elsewhere too.

    Symbols are as many bytes, 1 to ``widest``, as a power of two divides the length, and every string takes part
    from each byte of its first symbol, so that there are fewer rounds.
    """
    if not strings or max(map(len, strings)) < length:
        return np.empty(0, np.int64)
    width = min(length & -length, widest)
    text, sizes = _symbols(strings, width)
    length //= width
    ends, count = np.cumsum(sizes), len(sizes)

    def before(numbers: np.ndarray, suffix: int) -> np.ndarray:
        """The symbol in front of the suffix of this length; 0 at the string's start."""
        place = ends[numbers] - suffix - 1
        inside = suffix < sizes[numbers]
        return np.where(inside, text[np.where(inside, place, 0)], 0).astype(text.dtype)

    def insertion(symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where each position goes among the sorted sources of its symbol, by bisection of all at once."""
        low, high = starts[symbol], starts[symbol + 1]
        for _ in range(int((high - low).max()).bit_length()):
            open_ = low < high
            middle = (low + high) >> 1
            right = open_ & (sources[np.minimum(middle, len(sources) - 1)] < position) if len(sources) else open_ & False
            low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
        return low

    # streams over the sorted suffixes: symbol in front, common prefix with the one before
    numbers = np.arange(count)
    symbols = before(numbers, 0)
    transform = symbols
    common = np.zeros(count, np.uint16)
    place = np.int32 if len(text) < 1 << 31 else np.int64
    # positions of the suffixes, by the symbol in front: the order of the suffixes one longer; where each symbol starts
    sources = np.empty(0, place)
    starts = np.zeros(int(text.max()) + 2, np.int64)
    fresh = np.arange(count)
    for size in range(1, int(sizes.max()) + 1):
        inside = np.flatnonzero(symbols)
        if not len(inside):
            break
        by_key = inside[np.argsort((symbols[inside].astype(np.int64) << 32) | fresh[inside])]
        numbers, symbol, position = numbers[by_key], symbols[by_key], fresh[by_key].astype(sources.dtype)
        at = insertion(symbol.astype(np.int64), position)
        sources = np.insert(sources, at, position)
        at = at + np.arange(len(at))
        starts[1:] += np.cumsum(np.bincount(symbol, minlength=len(starts) - 1))
        # common prefixes of each new suffix with the one before it and the one after it
        after = at + 1
        after = after[np.append(after[:-1] != at[1:], after[-1] < len(sources))]
        touched = np.sort(np.concatenate([at, after]), kind="stable")
        here, there = sources[touched], sources[np.maximum(touched - 1, 0)]
        alike = (touched > 0) & (transform[here] == transform[there])
        prefix = np.zeros(len(touched), np.uint16)
        if alike.any():
            bounds = np.stack([there[alike] + 1, here[alike] + 1], 1).reshape(-1)
            padded = np.append(common, np.uint16(0))
            prefix[alike] = np.minimum.reduceat(padded, bounds)[::2] + 1
        # the next streams: the old ones with the new suffixes put in, read once from front to back
        fresh, symbols = count + at, before(numbers, size)
        kept = np.ones(count + len(sources), bool)
        kept[fresh] = False
        stream = np.empty(len(kept), transform.dtype)
        stream[kept], stream[fresh] = transform, symbols
        shared = np.empty(len(kept), np.uint16)
        shared[kept] = common
        shared[count + touched] = prefix
        sources = np.flatnonzero(kept).astype(place).take(sources)
        transform, common = stream, shared
    # where the suffixes lie in the text, from the transform alone: the ranks of the symbols lead from each to the one longer
    places, rank = np.empty(len(transform), place), np.empty(len(transform), place)
    rank[sources] = np.arange(len(sources), dtype=place)
    numbers, spot, size = np.arange(count), np.arange(count), 0
    while len(spot):
        places[spot] = ends[numbers] - size
        inside = transform[spot] != 0
        numbers, spot, size = numbers[inside], count + rank[spot[inside]], size + 1
    long = common >= length
    found = places[long | np.append(long[1:], False)].astype(np.int64)
    owner = np.searchsorted(ends, found, "right")
    return (owner // width << 32) | ((found - (ends - sizes)[owner]) * width + owner % width)
