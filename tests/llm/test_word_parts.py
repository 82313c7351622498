"""Words encoded in one text, lines without arrays, shuffle files of written tables."""

from __future__ import annotations

import os
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from linkloom.llm.bound import tokenizer_file
from linkloom.llm.column_bwt import repeated_starts
from linkloom.llm.rangecoder import _Model, decode_block, encode_block
from linkloom.llm.store import written
from linkloom.llm.templates import _lines
from linkloom.llm.wordcache import WordCache


def test_words_share_encodings_and_ids_stay(monkeypatch):
    texts = ["The the THE, the. the,%%% éTÉ été. don't I'll 's 4.0. BY-NC DE,!!", None, "", " ", "a\0b \0 \0\0 c", "x  y\n\nz\ta b", "Σας ΟΔΟΣ İ ß ẞ é İ",
             "<|endoftext|> a<|endoftext|>b Ā Ġ", "日本語 １２３ ½ ª ² 😀 a, . ,", "straße Œuvre ǅ ñÑ÷×"]
    cache = WordCache(tokenizer_file("word_bpe_49k.json"))
    passed = []
    several = cache._encode_words
    monkeypatch.setattr(cache, "_encode_words", lambda words: (passed.extend(words), several(words)))
    ids, counts = cache.encode(texts)
    whole = [cache._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]
    # one encoding for all forms of a word
    assert passed.count("the") == 1 and passed.count("été") == 1 and "THE" not in passed
    assert np.array_equal(cache.encode(texts)[0], ids)


def test_byte_level_words_share_encodings(monkeypatch):
    texts = ["The the THE, the.\nthe,%%% éTÉ ?!the the's", "the", None, "", "\nthe\n", " the", "the ", "a\0the \0", "the  the\n\nthe\tthe a\u00a0b", "日本語 <|endoftext|> the<|endoftext|>",
             "\x1c a\u2003b", "4.0. BY-NC DE,!! ½ ª"]
    cache = WordCache(tokenizer_file("byte_bpe_50k.json"))
    passed = []
    several = cache._encode_words
    monkeypatch.setattr(cache, "_encode_words", lambda words, lead="": (passed.extend(words), several(words, lead)))
    ids, counts = cache.encode(texts)
    whole = [cache._tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]
    # a word counts apart from its marks, with and without a space before it
    assert passed.count("the") == 1 and passed.count("\0the") == 1 and "the," not in passed
    assert np.array_equal(cache.encode(texts[::-1])[1], counts[::-1])


def test_blocks_keep_their_bytes_in_lean_arrays():
    rnd = np.random.default_rng(3)
    ids = np.where(rnd.random(40_000) < 0.5, rnd.integers(0, 9, 40_000), rnd.integers(0, 700, 40_000)).astype(np.uint32)
    block = encode_block([None, 7], [39_999, 1], ids, 700, lane_ids=64)
    # blocks written by earlier versions stay readable
    assert zlib.crc32(block) == 558161692
    docs, counts, back = decode_block(block)
    assert docs == [None, 7] and counts.tolist() == [39_999, 1] and np.array_equal(back, ids)
    # guess and confidence of a context are one entry, so a step looks up two tables, not four
    tables = [v for v in vars(_Model(2, 5)).values() if isinstance(v, np.ndarray) and len(v) >= 1 << 16]
    assert len(tables) == 2


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def files() -> set[str]:
        tops = {os.path.dirname(os.path.dirname(f)) for f in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()}
        return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before = files()
    rows = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "groups")
    until = time.time() + 10
    while not files() <= before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before
    assert rows.count() == 7


def test_wide_symbols_find_the_same_starts():
    rnd = np.random.default_rng(5)
    base = rnd.integers(97, 100, 300).astype(np.uint8).tobytes()
    strings = [base[a : a + n] + rnd.integers(0, 256, k).astype(np.uint8).tobytes() for a, n, k in rnd.integers(0, 90, (60, 3)).tolist()] + [b"", b"ab" * 60, b"a" * 9]
    for length in (16, 20, 22, 25):
        where: dict[bytes, list[int]] = {}
        for number, string in enumerate(strings):
            for start in range(len(string) - length + 1):
                where.setdefault(string[start : start + length], []).append(number << 32 | start)
        want = sorted(x for v in where.values() if len(v) > 1 for x in v)
        assert want
        for widest in (1, 2, 4, 8):
            assert sorted(repeated_starts(strings, length, widest=widest).tolist()) == want


def test_a_line_passes_each_rule_once(spark):
    texts = spark.createDataFrame([(1, "a\tb  7 \n\n  \n c\x0b\x0cd9e\t\t12 \nx y"), (2, None), (3, "")], "_id int, _text string")
    got = [(r._id, r._no, r._tok, r._size) for r in _lines(texts, ["_id"]).collect()]
    assert sorted(got) == [(1, 0, "a b <*>", 3), (1, 3, "c <*> <*>", 3), (1, 4, "x y", 2)]
    # a generator's expressions are not shared, so a text that is named twice there would be made twice
    generators = [x for x in _lines(texts, ["_id"])._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate" in x]
    assert generators and not any("RLIKE" in x or "regexp_replace" in x for x in generators)
