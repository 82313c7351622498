"""Quality scores by a vote of the nearest labelled texts in a latent-semantic space.

A text's terms are its hashed byte trigrams, the hashed shapes of its words, and its repeated words
and word triples.  A bounded sample of labelled texts gives the terms' weights and the leading singular
directions of the sample's term table.  The sample's vectors in these directions are broadcast; every
text's cosine with each of them is computed block by block, and the labels of its nearest neighbours are averaged,
weighted by a power of their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms: trigrams, word shapes, and counts of repeated words, repeated triples and words.
_TRIGRAMS, _SHAPES = 1536, 509
TERMS = _TRIGRAMS + _SHAPES + 3
_SLICE, _BLOCK = 1 << 20, 256
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_BYTES = np.arange(256)
_BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
#: Letters in lower case and digits as 0, for trigrams; kinds of characters, for shapes.
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, np.where((_BYTES >= 48) & (_BYTES <= 57), 48, np.where(_BLANK, 32, _BYTES))).astype(np.uint32)
_KIND = np.where((_BYTES >= 65) & (_BYTES <= 90), ord("X"), np.where((_BYTES >= 48) & (_BYTES <= 57), ord("9"), _BYTES))
_KIND = np.where(((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128), ord("x"), _KIND).astype(np.uint64)


class Votes(NamedTuple):
    """What a vote needs: term weights, directions, the labelled vectors and their labels, and the share of label 1."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _slices(data: bytes) -> Iterator[bytes]:
    """Pieces of about a megabyte, cut after white space."""
    while len(data) > _SLICE:
        cut = max(data.rfind(b, 0, _SLICE) for b in (b" ", b"\n")) + 1 or _SLICE
        yield data[:cut]
        data = data[cut:]
    if data:
        yield data


def _of_words(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each stretch of codes."""
    place = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
    out = np.add.reduceat((codes + np.uint64(1)) * _A * ((place.astype(np.uint64) * _B) | np.uint64(1)), first)
    return out ^ (out >> np.uint64(31))


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the terms of the whole text."""
    out = np.zeros(TERMS)
    triples = np.empty(0, np.uint64)
    total = 0
    for part in _slices((text or "").encode()):
        data = np.frombuffer(part, np.uint8)
        folded = _FOLDED[data]
        if len(data) > 2:
            grams = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
            out[:_TRIGRAMS] += np.bincount(((grams * np.uint32(2654435761)) >> np.uint32(16)) % _TRIGRAMS, minlength=_TRIGRAMS)
        place = np.flatnonzero(~_BLANK[data])
        if not len(place):
            continue
        first = np.flatnonzero(np.append(True, np.diff(place) > 1))
        words = _of_words(data[place].astype(np.uint64), first)
        kinds = _KIND[data[place]]
        change = np.append(True, kinds[1:] != kinds[:-1])
        change[first] = True
        shapes = _of_words(kinds[change], np.cumsum(change)[first] - 1)
        out[_TRIGRAMS : _TRIGRAMS + _SHAPES] += np.bincount((shapes % np.uint64(_SHAPES)).astype(np.int64), minlength=_SHAPES)
        out[-3] += np.count_nonzero(words[1:] == words[:-1])
        out[-1] += len(words) / 2
        if len(words) > 2:
            threes = words[:-2] * _A + words[1:-1] * _B + words[2:]
            total += len(threes)
            triples = np.union1d(triples, threes)
    out[-2] = total - len(triples)
    return out


def _terms(texts: list[str | None]) -> np.ndarray:
    """Square roots of the shares of trigrams, and of the other terms, in each text."""
    counts = np.stack([term_counts(t) for t in texts]) if texts else np.empty((0, TERMS))
    for part in (counts[:, :_TRIGRAMS], counts[:, _TRIGRAMS:]):
        part /= np.maximum(part.sum(1, keepdims=True), 1)
    return np.sqrt(counts)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _placed(terms: np.ndarray, weights: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return _unit(_unit(terms * weights) @ directions).astype(np.float32)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row.astype(np.float32).tobytes() for row in _terms(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "terms"])


def fit_votes(docs: DataFrame, labels: DataFrame, fit_rows: int = 4096, rank: int = 32, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality") -> Votes:
    """The latent space and the labelled vectors of at most ``fit_rows`` labelled documents, chosen by a hash of their ids.

    Labels of a repeated id are averaged, its least text stands for it; rows without id or label teach
    nothing.  Without labelled rows every score is a half.
    """
    wanted = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        (F.avg(label_col) >= 0.5).cast("int").alias("label"))
    sample = wanted.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    texts = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("text")).join(F.broadcast(sample), "_id")
    rows = texts.groupBy("_id", "label").agg(F.min("text").alias("text")).select("label", "text").mapInArrow(
        _described, "label int, terms binary").collect()
    if not rows:
        return Votes(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    # the same order of rows gives the same directions
    rows.sort(key=lambda r: (bytes(r.terms), r.label))
    terms = np.stack([np.frombuffer(r.terms, np.float32) for r in rows]).astype(np.float64)
    target = np.array([r.label for r in rows], np.float64)
    weights = 1 + np.log((1 + len(terms)) / (1 + (terms > 0).sum(0)))
    table = _unit(terms * weights)
    # leading right singular vectors by subspace iteration
    rank = min(rank, len(table))
    basis = np.random.default_rng(7).standard_normal((TERMS, min(rank + 16, len(table))))
    for _ in range(12):
        basis, _ = np.linalg.qr(table.T @ (table @ np.linalg.qr(basis)[0]))
    _, size, turn = np.linalg.svd(table @ basis, full_matrices=False)
    # a root of the singular values evens the directions out
    directions = (basis @ turn.T)[:, :rank] / np.sqrt(np.maximum(size[:rank], 1e-9))
    return Votes(weights, directions, _placed(terms, weights, directions), target, float(target.mean()))


def vote(texts: list[str | None], votes: Votes, neighbours: int, power: float) -> np.ndarray:
    """The score of each text."""
    out = np.full(len(texts), votes.prior)
    if not len(votes.vectors):
        return out
    for lo in range(0, len(texts), _BLOCK):
        cosine = _placed(_terms(texts[lo : lo + _BLOCK]), votes.weights, votes.directions) @ votes.vectors.T
        # rounded, so that equal texts take part alike in whichever block they come; ties take part together
        cosine = np.maximum(np.round(cosine.astype(np.float64), 5), 0)
        k = min(neighbours, cosine.shape[1])
        least = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, cosine.shape[1] - k, None]
        weight = np.where(cosine >= least, cosine**power, 0)
        total = weight.sum(1)
        out[lo : lo + _BLOCK] = np.where(total > 0, weight @ votes.labels / np.maximum(total, 1e-300), votes.prior)
    return np.round(np.clip(out, 0, 1), 6)


def score_quality(docs: DataFrame, labels: DataFrame, neighbours: int = 25, power: float = 4.0, fit_rows: int = 4096, rank: int = 32,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) per row of ``docs``: how likely label 1 is, from 0 to 1.

    The score is a function of the text alone, given the labelled sample (see :func:`fit_votes`); ``neighbours`` texts vote,
    and more where similarities tie.  A null, empty or blank text, like any text unlike all labelled ones, scores the
    sample's share of label 1.  Rows with null or repeated ids are scored one by one; an empty table gives no rows; other
    columns are ignored.
    """
    votes = docs.sparkSession.sparkContext.broadcast(fit_votes(docs, labels, fit_rows, rank, id_col, text_col, label_col))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(vote(batch.column(1).to_pylist(), votes.value, neighbours, power))], ["doc_id", "score"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(scored, "doc_id long, score double")
