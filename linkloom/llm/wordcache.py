"""Exact tokenizer output from a per-task cache of text pieces.

The vocabularies' own split patterns never join a character to what stands before a single
space (or across any white space at all, where white space is dropped), so a text may be cut
there, each distinct piece encoded once by the tokenizers library, and the ids put together
again.  Texts with other white space go through a slower cut that is just as safe.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Sequence
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Steps before the model of a word vocabulary.  They lower a plain word's letters, write its bytes as characters and part it from
#: the marks after it, so both may be encoded apart.
_WORD_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None,
}
#: Steps of a byte-level vocabulary.  They part a word from the marks after it, and a single line end from what stands on both sides.
_BYTE_STEPS = {
    "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    "post_processor": None, "truncation": None, "padding": None,
}
_MARKS = ".,%&*#$!?;:"
_PLAIN = re.compile("[a-zà-öø-ÿß]+")
_PLAIN_CASED = re.compile("\0?[a-zA-ZÀ-ÖØ-öø-ÿ]+")
_MARKED = f"^(?P<word>\0?[a-zA-ZÀ-ÖØ-öø-ÿ]+)(?P<marks>[{_MARKS}]*)$"
#: Texts that go through the slower cut where white space is kept: a zero byte, white space but single spaces and line ends, a space at the end.
_ODD = "[\\x00\t\x0b-\r\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|[ \n][ \n]| $"
_SHOWN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The byte-level alphabet, in which the space stays a space.
_BYTES = {b: b for b in [*_SHOWN_BYTES, 0x20]} | {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN_BYTES) if b != 0x20}
_SPACE = chr(0x120)
_ZERO, _NONE = pa.scalar("\0", pa.large_string()), pa.scalar("", pa.large_string())
_PAIR = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_OTHER_SPACE = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "  ", "\n\n", " \n", "\n ")


def _single_spaces(text: str) -> bool:
    if text.isascii():
        return not any(s in text for s in _OTHER_SPACE)
    return _PAIR.search(text) is None


class _Codes(dict):
    """Number of each known piece, -1 for others."""

    def __missing__(self, piece: str) -> int:
        return -1


class WordCache:
    """Encode texts with a tokenizers file; ``limit`` bounds the pieces kept, ``longest`` their mean length."""

    def __init__(self, path: str, limit: int = 1_000_000, longest: int = 40):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._limit, self._longest = limit, longest
        # a pre-tokenizer that keeps white space marks it on the following word
        self._drops_space = not self._ids(" ")
        self._line_end = self._ids("\n")
        self._stop = {mark: self._ids(mark) for mark in ".,"}
        self._bare = self._model_of_words(Tokenizer)
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self._code = _Codes({"": 0})
        self._kept, self._first, self._count = array("I"), array("q", [0]), array("q", [0])
        self._letters = 0
        self._views = None

    def _cut(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """How many parts each text has, the distinct parts, and each part's place among these.

        Parts lie between single spaces and line ends; a plain word and the marks after it are two.
        """
        plain = pa.array(texts, pa.large_string()).fill_null("")
        if self._drops_space:
            return self._parts(pc.replace_substring(plain, "\n", " "))
        odd = pc.match_substring_regex(plain, _ODD)
        # "\0" marks a piece without a space before it
        spaced = pc.binary_join_element_wise(_ZERO, pc.replace_substring(plain, "\n", " \0\n \0"), _NONE)
        counts, flat, places = self._parts(pc.if_else(odd, _ZERO, spaced))
        odd = odd.to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(odd)
        if len(rows):
            slow = [self._pieces(texts[row] or "") for row in rows.tolist()]
            own = list(dict.fromkeys(p for pieces in slow for p in pieces))
            number = dict(zip(own, range(len(flat), len(flat) + len(own))))
            kept, counts = places[~np.repeat(odd, counts)], counts.copy()
            counts[rows] = list(map(len, slow))
            is_slow = np.repeat(odd, counts)
            among = np.empty(len(is_slow), np.int64)
            among[~is_slow], among[is_slow] = kept, [number[p] for pieces in slow for p in pieces]
            flat, places = flat + own, among
        return counts, flat, places

    def _parts(self, spaced: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
        cut = pc.split_pattern(spaced, " ")
        counts = pc.list_value_length(cut).to_numpy()
        coded = cut.flatten().dictionary_encode()
        pieces, places = coded.dictionary, coded.indices.to_numpy()
        if not self._bare:
            return counts, pieces.to_pylist(), places
        found = pc.extract_regex(pieces, _MARKED)
        words, marks = pc.struct_field(found, "word"), pc.struct_field(found, "marks")
        words, marks = (pc.utf8_lower(words), marks) if self._drops_space else (words, pc.binary_join_element_wise(_ZERO, marks, _NONE))
        both = pa.concat_arrays([pc.if_else(found.is_valid(), words, pieces), pc.if_else(found.is_valid(), marks, "")])
        both = both.dictionary_encode()
        return 2 * counts, both.dictionary.to_pylist(), both.indices.to_numpy().reshape(2, -1).T[places].reshape(-1)

    def _pieces(self, text: str) -> list[str]:
        if not text:
            return []
        if "\0" in text or not _single_spaces(text):
            # "\0" marks a piece that is encoded as it stands
            return ["\0" + p for p in _SAFE_CUT.split(text)]
        pieces = text.replace("\n", " \n").split(" ")
        pieces[0] = "\0" + pieces[0]
        if pieces[-1] == "" and len(pieces) > 1:
            pieces[-1] = "\0 "
        return pieces

    def _shown(self, piece: str) -> str:
        if self._drops_space:
            return piece
        if piece[:1] == "\0":
            return piece[1:]
        return piece if piece[:1] == "\n" else " " + piece

    def _core(self, piece: str) -> tuple[list[int], str, list[int]]:
        """Take off a line end before a letter and a full stop or comma after one: always tokens of their own."""
        before: list[int] = []
        after: list[int] = []
        if len(piece) > 1 and piece[-1] in ".," and piece[-2] in ascii_letters:
            after, piece = self._stop[piece[-1]], piece[:-1]
        if len(piece) > 1 and piece[0] == "\n" and piece[1] in ascii_letters:
            before, piece = self._line_end, "\0" + piece[1:]
        return before, piece, after

    def _keep(self, piece: str, ids: Sequence[int]) -> None:
        self._code[piece] = len(self._first)
        self._first.append(len(self._kept))
        self._count.append(len(ids))
        self._kept.extend(ids)
        self._letters += len(piece)

    def _learn(self, pieces: set[str]) -> None:
        # only short-lived tuples and strings are made here, over which the collector would walk again and again
        gc.disable()
        try:
            self._encode_new(pieces)
        finally:
            gc.enable()

    def _model_of_words(self, kind: type):
        """A tokenizer of plain words in the byte-level alphabet between spaces; None for vocabularies with other steps."""
        known = json.loads(self._tokenizer.to_str())
        steps = _WORD_STEPS if self._drops_space else _BYTE_STEPS
        if any(known[k] != v for k, v in steps.items()) or not all("|" in t["content"] for t in known["added_tokens"]):
            return None
        from tokenizers.pre_tokenizers import WhitespaceSplit

        bare = kind(self._tokenizer.model)
        bare.pre_tokenizer = WhitespaceSplit()
        # a zero byte is no part of a plain word, so its id parts the words' ids
        parting = self._ids("\0")
        mark = chr(_BYTES[0])
        self._parting = f" {mark} ", *parting
        # tokens that only begin a word after a space, and those that only end a word
        tokens = [bare.id_to_token(i) or "" for i in range(bare.get_vocab_size())]
        suffix = known["model"].get("end_of_word_suffix")
        self._first_of = np.array([t[:1] == _SPACE for t in tokens])
        self._last = np.array([bool(suffix) and t.endswith(suffix) for t in tokens])
        ids = bare.encode(f"a {mark} b", add_special_tokens=False).ids
        return bare if len(parting) == 1 and ids == [*self._ids("a"), *parting, *self._ids("b")] else None

    def _encode_words(self, words: list[str], lead: str = "") -> None:
        """Keep the ids of plain words, many of which go into one text, each with ``lead`` before it."""
        between, mark = self._parting
        marked = not lead and not self._last.any()
        for lo in range(0, len(words), 2_000):
            part = words[lo : lo + 2_000]
            text = " ".join([w[1:] if w[0] == "\0" else w for w in part]).encode().decode("latin-1").translate(_BYTES)
            text = lead + text.replace(" ", f" {lead}") if lead or not marked else text.replace(" ", between) + between
            ids = np.array(self._bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            if lead:
                counts = np.diff(np.flatnonzero(self._first_of[ids]), append=len(ids))
            else:
                ends = np.flatnonzero(ids == mark if marked else self._last[ids])
                counts, ids = np.diff(ends, prepend=-1) - marked, np.delete(ids, ends) if marked else ids
            if len(counts) != len(part):
                raise ValueError("the tokenizer joined words across spaces")
            self._keep_all(part, ids, counts)

    def _keep_all(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        at = len(self._first)
        self._code.update(zip(pieces, range(at, at + len(pieces))))
        self._first.frombytes((len(self._kept) + np.cumsum(counts) - counts).astype(np.int64).tobytes())
        self._count.frombytes(counts.astype(np.int64).tobytes())
        self._kept.frombytes(ids.astype(np.uint32).tobytes())
        self._letters += sum(map(len, pieces))
        self._views = None

    def _gathered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of these numbers one after another, and how many each has."""
        if self._views is None:
            self._views = np.array(self._kept, np.uint32), np.array(self._first), np.array(self._count)
        kept, first, count = self._views
        lens = count[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return kept[np.repeat(first[codes] - (ends - lens), lens) + np.arange(total)], lens

    def _encode_new(self, pieces: set[str]) -> None:
        if self._bare:
            plain = _PLAIN if self._drops_space else _PLAIN_CASED
            words = [p for p in pieces if plain.fullmatch(p)]
            if self._drops_space:
                self._encode_words(words)
            else:
                self._encode_words([p for p in words if p[0] != "\0"], _SPACE)
                self._encode_words([p for p in words if p[0] == "\0"])
            pieces = pieces.difference(words)
        todo = {p: self._core(p) for p in pieces}
        cores = [c for c in {core for _, core, _ in todo.values()} if c not in self._code]
        for lo in range(0, len(cores), 20_000):
            part = cores[lo : lo + 20_000]
            for core, done in zip(part, self._tokenizer.encode_batch_fast([self._shown(p) for p in part], add_special_tokens=False)):
                self._keep(core, done.ids)
        for piece, (before, core, after) in todo.items():
            if piece != core:
                at = self._code[core]
                first = self._first[at]
                self._keep(piece, [*before, *self._kept[first : first + self._count[at]], *after])
        self._views = None

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text (null: empty)."""
        if len(self._code) > self._limit or self._letters > self._limit * self._longest:
            self._clear()
        if self._drops_space or self._bare:
            lengths, flat, places = self._cut(texts)
        else:
            cut = [self._pieces(t or "") for t in texts]
            lengths, flat, places = list(map(len, cut)), [p for pieces in cut for p in pieces], None
        codes = np.fromiter(map(self._code.__getitem__, flat), np.int64, len(flat))
        unknown = np.flatnonzero(codes < 0).tolist()
        if unknown:
            self._learn({flat[i] for i in unknown})
            codes[unknown] = [self._code[flat[i]] for i in unknown]
        if places is not None:
            codes = codes[places]
        ids, lens = self._gathered(codes)
        bounds = np.cumsum([0, *lengths])
        at = np.concatenate([[0], np.cumsum(lens)])
        return ids, at[bounds[1:]] - at[bounds[:-1]]


_OPEN: dict[str, WordCache] = {}


def cache_for(path: str) -> WordCache:
    """One cache per Python worker and file; workers are reused by later tasks."""
    if path not in _OPEN:
        _OPEN[path] = WordCache(path)
    return _OPEN[path]


def slices(texts: Sequence[str | None], most: int = 4_000_000):
    """Index ranges of about ``most`` characters, so that one call's arrays stay small."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
