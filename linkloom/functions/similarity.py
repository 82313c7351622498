"""The string comparators over column names, as JVM-side expressions and, for many pairs of long texts, over Arrow batches.

The comparator is a Jaro-Winkler variant: the match window's upper end is
exclusive, and the argument order matters for words of equal length, so callers
state which side comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the comparator.
PREFIX_WEIGHT = 0.1
PREFIX_SCAN = 5
MAX_PREFIX = PREFIX_SCAN - 1

_TAKEN = "\\u0001"


def jarow_sql(a: str, b: str) -> str:
    """SQL text of the similarity of two string expressions (cheap references, please)."""
    swap = f"length({a}) > length({b})"
    pair = (
        f"named_struct('s', IF({swap}, {b}, {a}), 'l', IF({swap}, {a}, {b}), "
        f"'n', least(length({a}), length({b})), 'd', greatest(length({a}), length({b})) DIV 2 - 1)"
    )
    place = "locate(substring(w.l, i, 1), substring(z.s, r.lo + 1, greatest(r.hi - r.lo, 0)))"
    bounds = "named_struct('lo', greatest(0, i - 1 - w.d), 'hi', least(w.n, i - 1 + w.d))"
    widened = f"transform(array({bounds}), q -> named_struct('lo', q.lo, 'hi', q.hi + int(q.lo = q.hi)))[0]"
    step = (
        f"transform(transform(array({widened}), r -> named_struct('p', {place}, 'lo', r.lo)), "
        "t -> IF(t.p = 0, z, named_struct("
        f"'s', concat(substring(z.s, 1, t.lo + t.p - 1), '{_TAKEN}', substring(z.s, t.lo + t.p + 1)), "
        "'m', concat(z.m, substring(w.l, i, 1)))))[0]"
    )
    matched = f"aggregate(sequence(1, length(w.l)), named_struct('s', w.s, 'm', ''), (z, i) -> {step})"
    common = (
        f"coalesce(get(filter(sequence(0, least({PREFIX_SCAN}, w.n) - 1), "
        f"k -> substring(w.s, k + 1, 1) <> substring(w.l, k + 1, 1)), 0), least({PREFIX_SCAN}, w.n) - 1)"
    )
    in_short_order = (
        f"array_join(transform(filter(sequence(1, w.n), k -> substring(g.s, k, 1) = '{_TAKEN}'), "
        "k -> substring(w.s, k, 1)), '')"
    )
    score = (
        "IF(v.m = '', 0D, (length(v.m) / double(w.n) + length(v.m) / double(length(w.l)) + "
        "(length(v.m) - 0.5D * size(filter(sequence(1, length(v.m)), "
        "k -> substring(v.m, k, 1) <> substring(v.o, k, 1)))) / double(length(v.m))) * (1D / 3D))"
    )
    total = f"d + {PREFIX_WEIGHT}D * {common} * (1D - d)"
    full = (
        f"transform(array({pair}), w -> transform(transform(transform(array({matched}), "
        f"g -> named_struct('m', g.m, 'o', {in_short_order})), v -> {score}), d -> {total})[0])[0]"
    )
    return f"CASE WHEN {a} = {b} THEN 1D WHEN {a} = '' OR {b} = '' THEN 0D ELSE {full} END"


def jarow(a: str, b: str) -> Column:
    return F.expr(jarow_sql(a, b))


def _score(a: str, b: str) -> float:
    """The similarity of two texts that are neither equal nor blank, step by step as in ``jarow_sql``."""
    short, long = (b, a) if len(a) > len(b) else (a, b)
    n, size = len(short), len(long)
    reach = size // 2 - 1
    try:
        first, second = short.encode("latin-1"), long.encode("latin-1")
    except UnicodeEncodeError:
        codes = {"\x01": 1}
        for letter in short + long:
            codes.setdefault(letter, len(codes) + 1)
        # a byte a letter where there are few kinds of letters, else four, which are compared one by one
        first, second = ([codes[c] for c in t] for t in (short, long))
        if len(codes) < 256:
            first, second = bytes(first), bytes(second)
    left = bytearray(first) if isinstance(first, bytes) else _Letters(first)
    find, matched = left.find, []
    if reach > 0:
        for end, letter in enumerate(second[:reach], reach):
            if (at := find(letter, 0, end)) >= 0:
                left[at] = 1
                matched.append(letter)
        for begin, letter in enumerate(second[reach:]):
            if (at := find(letter, begin, begin + 2 * reach)) >= 0:
                left[at] = 1
                matched.append(letter)
    elif reach == 0:
        for i, letter in enumerate(second):
            if (at := find(letter, i, i + 1)) >= 0:
                left[at] = 1
                matched.append(letter)
    if not matched:
        return 0.0
    m = len(matched)
    ordered = [c for c, t in zip(first, left, strict=True) if t == 1]
    moved = m - sum(map(int.__eq__, matched, ordered))
    jaro = (m / n + m / size + (m - 0.5 * moved) / m) * (1.0 / 3.0)
    scan = min(PREFIX_SCAN, n)
    common = next((k for k in range(scan) if short[k] != long[k]), scan - 1)
    return jaro + PREFIX_WEIGHT * common * (1.0 - jaro)


class _Letters(list):
    """Letters of more than 255 kinds, with the search of a ``bytearray``."""

    def find(self, letter: int, lo: int, hi: int) -> int:
        try:
            return self.index(letter, lo, max(hi, lo))
        except ValueError:
            return -1


@F.arrow_udf(T.DoubleType())
def _scores(a: pa.Array, b: pa.Array) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
    return pa.array([None if x is None or y is None else 1.0 if x == y else _score(x, y) if x and y else 0.0 for x, y in pairs], pa.float64())


def jarow_batch(a: str, b: str) -> Column:
    """The same value as :func:`jarow`, made for a batch of rows at once: a letter takes a fraction of the expression's time."""
    return _scores(F.col(a), F.col(b))


def person_similarity_sql(a: str, b: str) -> str:
    """``LAST, FIRST`` comparison: 0 unless one given name contains the other.

    Both parts are weighted by the shorter one's length; names that do not have
    exactly two parts are compared whole.
    """
    parts = f"named_struct('x', split({a}, ' ?[.,] ?'), 'y', split({b}, ' ?[.,] ?'))"
    w0 = "least(length(p.x[0]), length(p.y[0]))"
    w1 = "least(length(p.x[1]), length(p.y[1]))"
    weighted = (
        f"({jarow_sql('p.x[0]', 'p.y[0]')}) * {w0} + ({jarow_sql('p.x[1]', 'p.y[1]')}) * {w1}"
    )
    return (
        f"transform(array({parts}), p -> CASE WHEN size(p.x) = 2 AND size(p.y) = 2 THEN "
        f"CASE WHEN contains(p.x[1], p.y[1]) OR contains(p.y[1], p.x[1]) "
        f"THEN try_divide({weighted}, {w0} + {w1}) ELSE 0D END "
        f"ELSE {jarow_sql(a, b)} END)[0]"
    )


def person_similarity(a: str, b: str) -> Column:
    return F.expr(person_similarity_sql(a, b))


def jaro_floor(threshold: float, prefix: int = MAX_PREFIX) -> float:
    """The least plain Jaro score a pair above ``threshold`` can have that begins with ``prefix`` equal letters."""
    return (threshold - PREFIX_WEIGHT * prefix) / (1 - PREFIX_WEIGHT * prefix)


def least_common_letters(threshold: float, length: str, other: str | None = None, a: str | None = None, b: str | None = None) -> str:
    """SQL for the least number of shared letters a pair above ``threshold`` needs.

    From d = (m/s + m/l + (m-t)/m)/3: m >= (3d-1)/(1/s + 1/l).  Without the other
    length the bound holds for every partner, as m cannot exceed its length.  With the texts ``a`` and ``b``
    themselves it takes their first letters into account, where they differ early.
    """
    if other is None:
        share = max(3 * jaro_floor(threshold) - 2, 0.0)
        return f"greatest(1, int(ceil({share!r}D * {length} - 1e-9D)))"
    rooms = [f"{3 * jaro_floor(threshold, k) - 1!r}D" for k in range(MAX_PREFIX + 1)]
    room = rooms[MAX_PREFIX]
    if a and b:
        differ = " ".join(f"WHEN substring({a}, {k + 1}, 1) <> substring({b}, {k + 1}, 1) THEN {rooms[k]}" for k in range(MAX_PREFIX))
        room = f"CASE {differ} ELSE {room} END"
    return f"greatest(1, int(ceil({room} / (1D / {length} + 1D / {other}) - 1e-9D)))"


#: Letters that have marks of their own and how many, a row for each number; others count as one more kind.
_MARKED = (
    (" ", 40, "X", 6, "J", 6, "Q", 6, "9", 3), ("E", 38, "M", 14, "0", 5, "1", 5), ("N", 30, "T", 30), ("A", 28, "I", 28, "Z", 6),
    ("O", 26, "R", 26, "K", 9), ("S", 24, "H", 22, "P", 12, "2", 4), ("D", 20, "L", 20, "U", 18, "3", 4), ("C", 16, "G", 12, "F", 12, "B", 12, "V", 8),
    ("Y", 12, "W", 12, "4", 4, "5", 4, "6", 4, "7", 4, "8", 4),
)
#: Numbers of a text's marks, the last for the letters without.
MARK_NUMBERS = len(_MARKED) + 1
_FOLDED = "abcdefghijklmnopqrstuvwxyzÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
_FOLD_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "AAAAAACEEEEIIIINOOOOOOUUUUY" * 2 + "Y"


def letter_marks(text: str) -> Column:
    """A text's letters as bits of some numbers, and how many letters have none.

    The first A, the second A and so on have a bit each, so bits that two texts share stand for shared letters.
    Small letters and accents count as their plain capitals, which adds shared letters and takes none away.
    """
    numbers = []
    for row in _MARKED:
        at, bits = 0, []
        for letter, most in zip(row[::2], row[1::2], strict=True):
            count = f"least(octet_length(t) - octet_length(replace(t, '{letter}', '')), {most})"
            bits.append(f"shiftleft(shiftleft(1L, {count}) - 1L, {at})")
            at += most
        numbers.append(" | ".join(bits))
    marks = f"transform(array(translate({text}, '{_FOLDED}', '{_FOLD_TO}')), t -> array({', '.join(numbers)}))[0]"
    rest = " - ".join(f"bit_count(m[{i}])" for i in range(len(_MARKED)))
    return F.expr(f"transform(array({marks}), m -> concat(m, array(bigint(length({text}) - {rest}))))[0]")


def common_letters_bound(a: Sequence[str], b: Sequence[str]) -> str:
    """SQL for a number of letters that two texts with these marks do not exceed in common."""
    *shared, rest = zip(a, b, strict=True)
    return f"({' + '.join(f'bit_count({x} & {y})' for x, y in shared)} + least({', '.join(rest)}))"
