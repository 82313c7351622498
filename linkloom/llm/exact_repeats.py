"""Removal of long byte strings that occur more than once, over all documents.

Every window of ``length`` bytes has an anchor: the q-gram of least hash in it.  Consecutive
windows with the same anchor form a run, whose bytes are one string; equal windows have equal
anchors, so they lie in strings of one anchor.  Anchors that occur once are dropped.  Equal
strings are merged, and the different strings of an anchor go, in buckets of bounded size, through the
column-wise construction of their collection's Burrows-Wheeler transform and common prefixes,
which tells the windows that begin elsewhere too.  Anchors with very many different strings
are decided window by window instead, by digests that are counted with map-side sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.column_bwt import repeated_starts
from linkloom.llm.store import written
from linkloom.operators.normalize import compute_once

GRAM = 32
RUN = 170
_PLACE_BITS = np.uint64(20)
_PLACE = np.uint64((1 << 20) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SLICE = 400_000


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    out = (data.astype(np.uint64) + np.uint64(1)) * _A
    size = 1
    while size < GRAM:
        out = (out[:-size] * _B ^ (out[:-size] >> np.uint64(29))) + out[size:]
        size *= 2
    return (out ^ (out >> np.uint64(32))) * _A


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` neighbours."""
    size, out = 1, keys
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _runs(pieces: list[bytes], length: int):
    """(piece, start, windows, anchor, repeats) of each run; ``repeats``: the anchor occurs in it again."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    if len(data) < length:
        return [np.empty(0, np.int64)] * 5
    hashes = _gram_hashes(data)
    place = np.arange(len(hashes), dtype=np.uint64)
    rank = hashes & ~_PLACE
    width = length - GRAM + 1
    first = (_least(rank | place, width) & _PLACE).astype(np.int64)
    last = (_PLACE - (_least(rank | (_PLACE - place), width) & _PLACE)).astype(np.int64)
    anchor = hashes[first]
    ends = np.cumsum(sizes)
    # windows that cross from one piece into the next are none
    valid = np.zeros(len(anchor) + 1, np.int32)
    whole = sizes >= length
    np.add.at(valid, (ends - sizes)[whole], 1)
    np.add.at(valid, (ends - length + 1)[whole], -1)
    valid = np.cumsum(valid[:-1]) > 0
    opens = valid.copy()
    opens[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    opens[np.minimum((ends - sizes)[whole], len(opens) - 1)] = True
    start = np.flatnonzero(opens)
    closes = np.append(opens[1:] | ~valid[1:], True) & valid
    windows = np.flatnonzero(closes) + 1 - start
    # very long runs come from periodic text; they are cut anywhere
    parts = -(-windows // RUN)
    at = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(start, parts) + at * RUN
    windows = np.minimum(np.repeat(windows, parts) - at * RUN, RUN)
    piece = np.searchsorted(ends, start, "right")
    repeats = first[start] != last[start + windows - 1]
    return piece, start - (ends - sizes)[piece], windows, anchor[start].view(np.int64), repeats


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(row, offset, bytes) lists of about a slice's size; long texts come in overlapping pieces."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), _SLICE):
            part = text[offset : offset + _SLICE + length - 1]
            if len(part) < length:
                continue
            rows.append(row), offsets.append(offset), parts.append(part)
            size += len(part)
            if size >= _SLICE:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, parts in _pieces([t or b"" for t in batch.column(0).to_pylist()], length):
            _, _, _, anchor, repeats = _runs(parts, length)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(repeats)], ["anchor", "repeats"])


def _occurrences(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).to_pylist()]
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for rows, offsets, parts in _pieces(texts, length):
            piece, start, windows, anchor, repeats = _runs(parts, length)
            form = [_digest(parts[p][s : s + n + length - 1]) for p, s, n in zip(piece.tolist(), start.tolist(), windows.tolist())]
            row = np.array(rows, np.int64)[piece]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(form, pa.int64()), pa.array(ids[row]), pa.array(marks[row]),
                 pa.array(((start + np.array(offsets, np.int64)[piece]) << 9) | (windows << 1) | repeats)],
                ["anchor", "form", "id", "mark", "span"])


def _bucket_repeats(table: pa.Table, length: int) -> pa.Table:
    anchor, form = table.column("anchor").to_numpy(), table.column("form").to_numpy()
    codes = np.sort(repeated_starts(table.column("data").to_pylist(), length))
    number, start = codes >> 32, codes & 0xFFFFFFFF
    opens = np.ones(len(codes), bool)
    opens[1:] = codes[1:] != codes[:-1] + 1
    first = np.flatnonzero(opens)
    size = np.diff(np.append(first, len(codes)))
    at = number[first]
    return pa.table({"anchor": anchor[at], "form": form[at], "lo": start[first], "windows": size})


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    schema = _OUT if with_text else pa.schema(list(_OUT)[:-1])
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = text or b""
            kept, at, removed, n_spans, stop = [], 0, 0, 0, -1
            for code in sorted(spans or ()):
                lo, hi = code >> 9, (code >> 9) + (code & 511) + length - 1
                if lo > stop:
                    n_spans += 1
                    kept.append(text[at:lo])
                    removed += hi - lo
                    stop = at = hi
                elif hi > stop:
                    removed += hi - stop
                    stop = at = hi
            kept.append(text[at:])
            left = b"".join(kept)
            rows.append((doc, len(text), removed, n_spans, hashlib.sha256(left).hexdigest(), left)[: len(schema)])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _substring(data: Column, start: Column, size: Column) -> Column:
    return F.substring(data, (start + 1).cast("int"), size.cast("int"))


def remove_repeats(docs: DataFrame, length: int = 200, bucket_bytes: int = 400_000, most_forms: int = 4096, with_text: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row of ``docs``.

    Removed is each byte covered by a string of ``length`` UTF-8 bytes that begins anywhere else
    too, in the same text or another; strings never cross texts and are judged on the input.
    ``kept`` are the other bytes in order.  Anchors with over ``most_forms`` different strings take
    the way by window digests, with the same result.

    A null text is empty.  Texts under ``length`` bytes stay whole.  Rows may repeat and ids may be null:
    each row gets its own result, and equal texts repeat each other.  An empty table gives no
    rows; other columns are ignored.
    """
    if not GRAM <= length <= 1 << 20:
        raise ValueError(f"length must be {GRAM} at least")
    text = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    # rows of one id and text are alike, so (id, mark) names what a row needs; without id both are halves of the text's digest
    half = [F.conv(F.substring(F.col("_md5"), k, 16), 16, -10).cast("long") for k in (1, 17)]
    digested = compute_once(docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("data")), "_md5", F.md5("data"))
    base = digested.select(F.coalesce("doc_id", half[0]).alias("id"), F.when(F.col("doc_id").isNull(), half[1]).otherwise(half[0]).alias("mark"), "data", "doc_id")
    anchors = docs.select(text.alias("data")).mapInArrow(lambda it: _anchors(it, length), "anchor long, repeats boolean")
    shared = written(
        anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.max("repeats").alias("_r")).where("_n > 1 or _r").select("anchor"), "anchors")
    found = base.select("id", "mark", "data").mapInArrow(
        lambda it: _occurrences(it, length), "anchor long, form long, id long, mark long, span long")
    spots = written(found.join(shared, "anchor"), "occurrences")

    forms = written(
        spots.groupBy("anchor", "form").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("span").bitwiseAND(1)).alias("_r"),
                                            F.min(F.struct("id", "mark", "span")).alias("_at")), "forms")
    per_anchor = forms.groupBy("anchor").agg(F.count(F.lit(1)).alias("_forms"), F.max("_r").alias("_again"), F.min("_n").alias("_least"))
    # a form seen twice repeats in all its windows; where an anchor has a form seen once, its forms are compared
    whole = forms.where("_n > 1").select("anchor", "form", F.lit(0).cast("long").alias("lo"),
                                         F.shiftright("_at.span", 1).bitwiseAND(255).alias("windows"))
    compared = forms.join(per_anchor.where("_least = 1 and (_forms > 1 or _again = 1)"), "anchor").select("anchor", "form", "_n", "_forms", "_at.*")
    fetch = (
        compared.groupBy("id", "mark").agg(F.collect_list(F.struct("anchor", "form", "_n", "_forms", "span")).alias("_want"))
        .join(base.select("id", "mark", "data"), ["id", "mark"])
    )
    cut = F.transform("_want", lambda w: F.struct(
        w["anchor"].alias("anchor"), w["form"].alias("form"), w["_n"].alias("_n"), w["_forms"].alias("_forms"),
        _substring(F.col("data"), F.shiftright(w["span"], 9), F.shiftright(w["span"], 1).bitwiseAND(255) + (length - 1)).alias("data")))
    strings = written(fetch.select(F.explode(cut).alias("_w")).select("_w.*").dropDuplicates(["anchor", "form"]), "strings")

    total = strings.where(F.col("_forms") <= most_forms).agg(F.sum(F.length("data"))).first()[0] or 0
    buckets = max(1, int(total) // bucket_bytes)
    compared_in_buckets = (
        strings.where(F.col("_forms") <= most_forms).withColumn("_bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("_bucket").applyInArrow(lambda t: _bucket_repeats(t, length), "anchor long, form long, lo long, windows long")
    )
    # anchors of very many forms: windows one by one, equal windows summed before the shuffle
    each = strings.where(F.col("_forms") > most_forms).select(
        "anchor", "form", "_n", "data", F.posexplode(F.sequence(F.lit(0), F.length("data") - length)).alias("_k", "lo"))
    each = each.select("anchor", "form", "_n", F.col("lo").cast("long").alias("lo"), F.md5(_substring(F.col("data"), F.col("lo"), F.lit(length))).alias("_w"))
    often = each.groupBy("anchor", "_w").agg(F.sum("_n").alias("_c")).where("_c > 1").select("anchor", "_w")
    singly = each.join(often, ["anchor", "_w"], "left_semi").select("anchor", "form", "lo", F.lit(1).cast("long").alias("windows"))

    repeated = written(whole.unionByName(compared_in_buckets).unionByName(singly), "repeated")
    spans = (
        spots.join(repeated, ["anchor", "form"])
        .groupBy("id", "mark").agg(F.collect_set(F.shiftleft(F.shiftright("span", 9) + F.col("lo"), 9) + F.col("windows")).alias("_spans"))
    )
    joined = base.join(spans, ["id", "mark"], "left").select("doc_id", "data", "_spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return joined.mapInArrow(lambda it: _cut(it, length, with_text), schema)
