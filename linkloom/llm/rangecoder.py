"""Blocks of token ids, coded by an adaptive range coder over mixed predictions.

A block is self-contained: header, document directory, lane lengths, code words, CRC-32.  Its
ids are dealt to ``lanes`` that step together through one shared model, so that numpy codes one
id of every lane at a time; every block starts with a fresh model.

The order-2 and the order-1 context each predict the id last seen after them, with a confidence
of 0-3.  Both confidences, and whether the two agree, choose the adaptive weights by which the
order-2 prediction, the order-1 prediction and the order-0 distribution (adaptive counts of ids)
are mixed.  The coder is a carryless 64-bit range coder that puts out 32-bit words.  All
arithmetic is on integers, so that every machine decodes alike.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_MAGIC = b"LLIC"
_HEAD = struct.Struct("<4sHHIIQIII")  # magic, version, -, documents, of them without id, ids, lanes, steps, vocabulary
_SLOT_BITS, _ID_BITS = 12, 22
_WORD = 32
_LOW = (1 << _WORD) - 1
_BITS1, _BITS2 = 16, 20


class BlockError(ValueError):
    """The block is damaged or of another format."""


class _Model:
    def __init__(self, lanes: int, vocabulary: int):
        self.v = vocabulary
        # per context the guess and below it, in two bits, its confidence
        self.table1, self.table2 = np.zeros(1 << _BITS1, np.uint32), np.zeros(1 << _BITS2, np.uint32)
        # the last id and the one before it, each times its factor of the hashes
        self.last = np.zeros(lanes, np.uint64)
        self.before = np.zeros(lanes, np.uint64)
        self.older = np.zeros(lanes, np.uint64)
        self.weight = np.tile(np.array([2, 1, 3], np.int64), (32, 1))
        self.counts = np.zeros(vocabulary, np.int64)
        self.fresh: list[np.ndarray] = []
        self.step = 0
        self._order0()

    def _order0(self) -> None:
        if self.fresh:
            self.counts += np.bincount(np.concatenate(self.fresh), minlength=self.v)
            self.fresh = []
        total, room = int(self.counts.sum()), (1 << _ID_BITS) - self.v
        freq = 1 + (self.counts * room // total if total else np.zeros(self.v, np.int64))
        freq[-1] += (1 << _ID_BITS) - int(freq.sum())
        self.cum0 = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint32)
        self.freq0 = freq.astype(np.uint32)

    def predict(self) -> None:
        """Guesses of both contexts, the mixing context and the weights of this step."""
        if self.step and (self.step & (self.step - 1) == 0 or self.step % 16 == 0):
            self._order0()
        self.i1 = (self.last >> (64 - _BITS1)).view(np.int64)
        self.i2 = (((self.before ^ self.last) * 0xD6E8FEB86659FD93) >> (64 - _BITS2)).view(np.int64)
        e1, e2 = self.table1[self.i1], self.table2[self.i2]
        self.g1, self.g2 = e1 >> 2, e2 >> 2
        self.c1, self.c2 = e1 & 3, e2 & 3
        #: the slots of a lane's mixing context begin here
        self.base = 3 * (((self.c2 << 3) | (self.c1 << 1) | (self.g1 == self.g2)).astype(np.int64))
        freq = 1 + self.weight * ((1 << _SLOT_BITS) - 3) // self.weight.sum(1, keepdims=True)
        freq[:, 2] += (1 << _SLOT_BITS) - freq.sum(1)
        self.slot_freq = freq.astype(np.uint64).reshape(-1)
        self.slot_cum = (np.cumsum(freq, 1) - freq).astype(np.uint64).reshape(-1)

    def update(self, ids: np.ndarray, hit1: np.ndarray, hit2: np.ndarray, place: np.ndarray, literals: np.ndarray) -> None:
        """Learn the step's ids, whether they are the guesses, and ``place``, the slots taken."""
        self.weight += 4 * np.bincount(place, minlength=96).reshape(32, 3)
        if len(literals):
            self.fresh.append(literals)
        entry = ids << 2
        # equal contexts of one step: the last lane's entry stays, on both sides
        self.table1[self.i1] = entry | (np.minimum(self.c1 + 1, 3) * hit1)
        self.table2[self.i2] = entry | (np.minimum(self.c2 + 1, 3) * hit2)
        wide = ids.astype(np.uint64)
        self.before, self.older, self.last = self.older, wide * 0xC2B2AE3D27D4EB4F, wide * 0x9E3779B97F4A7C15
        self.step += 1


def _encode_lanes(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    lanes, steps = ids.shape
    model = _Model(lanes, vocabulary)
    ids = np.ascontiguousarray(ids.T)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    out, used = np.empty((lanes, 2 * steps + 2), np.uint32), np.zeros(lanes, np.int64)

    def put(lane, cum, freq, bits) -> None:
        part = size[lane] >> bits
        start, width = low[lane] + part * cum, part * freq
        small = np.flatnonzero(width <= _LOW)
        if len(small):
            which = small if isinstance(lane, slice) else lane[small]
            base = start[small]
            out[which, used[which]] = base >> _WORD
            used[which] += 1
            # a range over a word boundary is cut there, so that the word is settled
            width[small] = np.minimum(width[small], (1 << _WORD) - (base & _LOW)) << _WORD
            start[small] = base << _WORD
        low[lane], size[lane] = start, width

    for t in range(steps):
        now = ids[t]
        model.predict()
        hit1, hit2 = now == model.g1, now == model.g2
        place = model.base + np.where(hit2, 0, 2 - hit1)
        put(slice(None), model.slot_cum[place], model.slot_freq[place], _SLOT_BITS)
        escaped = np.flatnonzero(~(hit1 | hit2))
        literals = now[escaped]
        if len(escaped):
            put(escaped, model.cum0[literals], model.freq0[literals], _ID_BITS)
        model.update(now, hit1, hit2, place, literals)
    every = np.arange(lanes)
    for word in (low >> _WORD, low & _LOW):
        out[every, used] = word
        used += 1
    return out[np.arange(out.shape[1]) < used[:, None]], used


def _decode_lanes(words: np.ndarray, used: np.ndarray, steps: int, vocabulary: int) -> np.ndarray:
    lanes = len(used)
    model = _Model(lanes, vocabulary)
    at = np.cumsum(used) - used
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = (words[at].astype(np.uint64) << _WORD) | words[at + 1]
    at += 2
    words = np.append(words, np.uint32(0))
    ids = np.empty((steps, lanes), np.uint32)

    def take(lane, part, cum, freq) -> None:
        start, width, left = low[lane] + part * cum, part * freq, code[lane] - part * cum
        small = np.flatnonzero(width <= _LOW)
        if len(small):
            which = small if isinstance(lane, slice) else lane[small]
            base = start[small]
            left[small] = (left[small] << _WORD) | words[at[which]]
            at[which] += 1
            width[small] = np.minimum(width[small], (1 << _WORD) - (base & _LOW)) << _WORD
            start[small] = base << _WORD
        low[lane], size[lane], code[lane] = start, width, left

    for t in range(steps):
        model.predict()
        part = size >> _SLOT_BITS
        slot = (code >= part * model.slot_cum[model.base + 1]).astype(np.int64) + (code >= part * model.slot_cum[model.base + 2])
        place = model.base + slot
        take(slice(None), part, model.slot_cum[place], model.slot_freq[place])
        now = np.where(slot == 0, model.g2, model.g1)
        escaped = np.flatnonzero(slot == 2)
        literals = np.empty(0, np.uint32)
        if len(escaped):
            part = size[escaped] >> _ID_BITS
            value = (code[escaped] // part).astype(np.uint32)
            # rising values are found near each other
            order = np.argsort(value)
            literals = np.empty(len(order), np.uint32)
            literals[order] = np.searchsorted(model.cum0[1:], value[order], side="right")
            take(escaped, part, model.cum0[literals], model.freq0[literals])
            now[escaped] = literals
        ids[t] = now
        model.update(now, now == model.g1, now == model.g2, place, literals)
    return np.ascontiguousarray(ids.T)


def encode_block(doc_ids: list, counts: list, ids: np.ndarray, vocabulary: int,
                 most_lanes: int = 8192, lane_ids: int = 128) -> bytes:
    """One block of whole documents, those without id (None) first; ``ids`` are below ``vocabulary`` (at most 2**21)."""
    nameless = sum(d is None for d in doc_ids)
    if any(d is not None for d in doc_ids[:nameless]):
        raise ValueError("documents without id must come first")
    if vocabulary > 1 << (_ID_BITS - 1) or (len(ids) and int(ids.max()) >= vocabulary):
        raise ValueError("an id lies outside the vocabulary")
    lanes = max(1, min(most_lanes, len(ids) // lane_ids))
    steps = -(-len(ids) // lanes)
    padded = np.zeros(lanes * steps, np.uint32)
    padded[: len(ids)] = ids
    words, used = _encode_lanes(padded.reshape(lanes, steps), vocabulary)
    body = b"".join([
        _HEAD.pack(_MAGIC, 1, 0, len(doc_ids), nameless, len(ids), lanes, steps, vocabulary),
        np.asarray([0] * nameless + list(doc_ids[nameless:]), "<i8").tobytes(), np.asarray(counts, "<u8").tobytes(),
        used.astype("<u4").tobytes(), words.astype("<u4").tobytes(),
    ])
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(block: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, id counts, ids) of a block; BlockError where its check fails."""
    if len(block) < _HEAD.size + 4 or block[:4] != _MAGIC:
        raise BlockError("not a block")
    body = memoryview(block)[:-4]
    if zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise BlockError("checksum differs")
    _, version, _, n_docs, nameless, n_ids, lanes, steps, vocabulary = _HEAD.unpack_from(block)
    if version != 1:
        raise BlockError(f"version {version}")
    at = _HEAD.size
    doc_ids = [None] * nameless + np.frombuffer(body, "<i8", n_docs, at)[nameless:].tolist()
    counts = np.frombuffer(body, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    used = np.frombuffer(body, "<u4", lanes, at + 16 * n_docs).astype(np.int64)
    words = np.frombuffer(body, "<u4", int(used.sum()), at + 16 * n_docs + 4 * lanes)
    return doc_ids, counts, _decode_lanes(words, used, steps, vocabulary).reshape(-1)[:n_ids]
