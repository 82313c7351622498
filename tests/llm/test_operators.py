"""The training-data operators on small tables with odd rows, against plain brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from linkloom.llm.bound import tokenizer_file  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, n_lines string, part string, content string, rep string, _drop string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ly", "er", "."]) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = prose(1, 12_000)
    near = prose(2, 200).split(" ")
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, long), (7, prose(2, 200)), (8, " ".join(near[:-1] + ["changed"])),
        (9, prose(3, 120)), (9, prose(3, 120)), (None, prose(4, 120)), (None, None), (10, prose(3, 120)), (11, "a" * 900),
        (12, "é" * 300 + " ünïcödé 日本語 テスト " * 20), (13, "x <|endoftext|> y  z\n\n w"), (14, prose(5, 60) + " " + prose(9, 60)), (15, prose(9, 60)),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "web", None, "x", "y", "z", "p", "c", "r", "d") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(row):
    return tuple((v is None, v) for v in row)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


# ---- 1: exact repeats

def covered(texts: list[bytes], length: int):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(mark)))
        left = bytes(b for b, m in zip(t, mark) if not m)
        out.append((len(t), sum(mark), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("most_forms", [4096, 1])
def test_exact_repeats_equal_brute_force(spark, odd, none, most_forms):
    from linkloom.llm.exact_repeats import remove_repeats

    base = [(r[0], (r[1] or "").encode()) for r in odd_rows()]
    want = sorted([(i, *c) for (i, _), c in zip(base, covered([t for _, t in base], 60))], key=key)
    got = rows(remove_repeats(odd, length=60, most_forms=most_forms, bucket_bytes=2000), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == want
    if most_forms == 1:
        assert remove_repeats(none, length=60).count() == 0


def test_texts_without_id_and_of_one_checksum_keep_their_own_spans(spark):
    from linkloom.llm.exact_repeats import remove_repeats

    shared, other = prose(90_000, 60), prose(90_001, 60)
    starts = [zlib.crc32(b"true" + (t + " ").encode()) for t in (shared, other)]
    rnd = random.Random(1)
    numbers = [rnd.getrandbits(60) for _ in range(300_000)]
    tails = {zlib.crc32(b"%x" % n, starts[0]): f"{n:x}" for n in numbers}
    i, j = next((tails[c], f"{n:x}") for n in numbers if (c := zlib.crc32(b"%x" % n, starts[1])) in tails)
    docs = [(1, shared), (None, f"{shared} {i}"), (None, f"{other} {j}")]
    got = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True).collect()
    removed = {(r.doc_id, r.n_bytes, bytes(r.kept)): r.n_removed for r in got}
    assert removed == {(1, len(shared), b""): len(shared), (None, len(docs[1][1]), f" {i}".encode()): len(shared),
                       (None, len(docs[2][1]), docs[2][1].encode()): 0}


def test_column_transform_finds_all_repeats():
    from linkloom.llm.column_bwt import repeated_starts

    rnd = random.Random(3)
    for _ in range(150):
        strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 14))) for _ in range(rnd.randint(1, 9))]
        length = rnd.randint(1, 6)
        where = defaultdict(list)
        for i, s in enumerate(strings):
            for p in range(len(s) - length + 1):
                where[s[p : p + length]].append((i << 32) | p)
        assert sorted(repeated_starts(strings, length).tolist()) == sorted(x for v in where.values() if len(v) > 1 for x in v)
    every = bytes(range(256)) * 2
    assert len(repeated_starts([every], 100)) == 2 * (256 - 99)


# ---- 2, 6, 10: tokens

def plain_ids(name: str, texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(tokenizer_file(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_cache_equals_the_library(name):
    from linkloom.llm.wordcache import WordCache

    rnd = random.Random(1)
    bits = ["a", "B", " ", " ", "\n", "'s", "1", "é", "́", "\t", " ", " ", "<|endoftext|>", ".", ",", "\x1c", "\0", "\u0085", "word", "日"]
    texts = [None, "", " ", *("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(3000)), prose(7, 5000)]
    cache = WordCache(tokenizer_file(name), limit=500)
    for lo in range(0, len(texts), 700):
        part = texts[lo : lo + 700]
        ids, counts = cache.encode(part)
        at = 0
        for want, n in zip(plain_ids(name, part), counts):
            assert ids[at : at + n].tolist() == want
            at += n


def crc(ids) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_token_files_round_trip(spark, odd, none, tmp_path):
    from linkloom.llm.token_files import read_ids, write_ids

    path = tokenizer_file("word_bpe_49k.json")
    write_ids(odd, f"{tmp_path}/ids", path, end_id=2, vocabulary=49_408, block_ids=3000)
    got = sorted((tuple(r) for r in read_ids(spark, f"{tmp_path}/ids").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in odd_rows()), key=lambda i: (i is not None, i))
    want = Counter((r[0], tuple(ids + [2])) for r, ids in zip(odd_rows(), plain_ids("word_bpe_49k.json", [r[1] for r in odd_rows()])))
    assert Counter((r[0], tuple(r[4])) for r in got) == want
    start = 0
    for _, at, n, check, ids in got:
        assert (at, n, check) == (start, len(ids), crc(ids))
        start += n
    write_ids(none, f"{tmp_path}/empty", path, end_id=2, vocabulary=49_408)
    assert read_ids(spark, f"{tmp_path}/empty", with_ids=False).count() == 0


def test_blocks_round_trip_and_tell_damage():
    import numpy as np

    from linkloom.llm.rangecoder import BlockError, decode_block, encode_block

    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 500, 40_000):
        ids = (rng.zipf(1.2, n) % 1000).astype(np.uint32)
        block = encode_block([None, 5], [n, 0], ids, 1000, lane_ids=64)
        docs, counts, back = decode_block(block)
        assert (docs, counts.tolist(), back.tolist()) == ([None, 5], [n, 0], ids.tolist())
    constant = encode_block([1], [40_000], np.zeros(40_000, np.uint32), 1000)
    assert len(constant) < 8_000
    for at in (4, len(block) // 2, len(block) - 2):
        with pytest.raises(BlockError):
            decode_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])
    with pytest.raises(ValueError):
        encode_block([1], [1], np.array([1000], np.uint32), 1000)


def test_token_counts_and_cache(spark, odd, none, tmp_path):
    from linkloom.llm.token_counts import CACHE, count_tokens

    path, cache = tokenizer_file("byte_bpe_50k.json"), f"{tmp_path}/cache"
    want = sorted(((r[0], len((r[1] or "").encode()), len(ids), len(ids) > 100) for r, ids in
                   zip(odd_rows(), plain_ids("byte_bpe_50k.json", [r[1] for r in odd_rows()]))), key=key)
    names = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert rows(count_tokens(odd, path, cache, limit=100), *names) == want
    stored = spark.read.schema(CACHE).parquet(cache).count()
    assert stored == len({r[1] or "" for r in odd_rows()})
    assert rows(count_tokens(odd, path, cache, limit=100), *names) == want
    assert spark.read.schema(CACHE).parquet(cache).count() == stored
    assert count_tokens(none, path, f"{tmp_path}/none").count() == 0


def test_packing_holds_every_id_once(odd, none):
    from linkloom.llm.packing import differencing_windows, pack_documents

    path = tokenizer_file("byte_bpe_50k.json")
    got = pack_documents(odd, path, capacity=256, piece=64).collect()
    want = Counter((r[0], len(ids) + 1) for r, ids in zip(odd_rows(), plain_ids("byte_bpe_50k.json", [r[1] for r in odd_rows()])))
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(n * c for (_, n), c in want.items())
    assert sum(r.length for r in got) == total
    pieces = {(r.doc_id, r.start): r for r in got}
    ids = plain_ids("byte_bpe_50k.json", [prose(2, 200)])[0] + [0]
    at = 0
    while at < len(ids):
        piece = pieces[(7, at)]
        assert piece.ids_crc32 == crc(ids[at : at + piece.length])
        at += piece.length
    assert pack_documents(none, path).count() == 0

    import numpy as np

    rng = np.random.default_rng(1)
    weights = rng.integers(1, 257, 1500)
    bins = differencing_windows(weights, 1024)
    sums = np.bincount(bins, weights=weights)
    assert sums.max() <= 1024 and sums.sum() / (len(sums) * 1024) > 0.97
    assert differencing_windows(np.array([1024, 1024, 1]), 1024).max() == 2


# ---- 3: quality

def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeat = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat)


def test_quality_statistics_and_outliers(spark, odd, none):
    from linkloom.llm.quality import quality_verdicts

    got = quality_verdicts(odd).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted(((r[0], *statistics(r[1])) for r in odd_rows()), key=key)
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_verdicts(none).count() == 0

    many = [(i, prose(i, 60 + i), "en", f"s{i % 2}") for i in range(500)]
    many += [(1000 + i, re.sub(" ", " ### ", prose(i, 80)), "en", f"s{i % 2}") for i in range(40)]
    verdicts = quality_verdicts(spark.createDataFrame(many, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id for r in verdicts.where("kept").collect()}
    assert kept == set(range(500))


# ---- 4: WARC

PAGES = "page_id long, url string, html string, payload string, digest string"


def page_rows():
    return [(1, "http://a/", "<p>x</p>", "", ""), (2, None, "<p>x</p>", "", ""), (3, "http://a b\r\nX: y", None, "", ""), (4, "", "", "", ""),
            (5, "http://ü/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é" * 5000, "", ""), (None, "u", "lone", "", ""), (6, "u", "<p>x</p>", "", ""), (6, "u", "<p>x</p>", "", "")]


def sha1_32(data: bytes) -> str:
    import base64

    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    from linkloom.llm.warc import read_warc, write_warc

    write_warc(spark.createDataFrame(page_rows(), PAGES), f"{tmp_path}/w", records_per_file=2)
    got = read_warc(spark, f"{tmp_path}/w", with_payload=True).collect()
    assert {r.kind for r in got} == {"record"}
    groups = defaultdict(list)
    for i, _, html, *_ in page_rows():
        groups[html or ""].append(i)
    want = []
    for i, _, html, *_ in page_rows():
        best = max((x for x in groups[html or ""] if x is not None), default=None)
        data = (html or "").encode()
        want.append((f"<urn:page:{'' if i is None else i}>", len(data), sha1_32(data), "response" if best is None or i == best else "revisit",
                     None if best is None or i == best else f"<urn:page:{best}>"))
    assert sorted((tuple(r) for r in [(g.record_id, g.payload_bytes, g.payload_digest, g.record_type, g.refers_to) for g in got]), key=key) == sorted(want, key=key)
    by_id = {g.record_id: bytes(g.payload) for g in got if g.record_type == "response"}
    assert by_id["<urn:page:5>"] == page_rows()[4][2].encode()
    write_warc(spark.createDataFrame([], PAGES), f"{tmp_path}/e")
    assert read_warc(spark, f"{tmp_path}/e").where("kind = 'record'").count() == 0


def record(number: int, payload: bytes) -> bytes:
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:{number}>\r\nWARC-Payload-Digest: sha1:{sha1_32(payload)}\r\n"
            f"Content-Type: text/plain\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    return head + payload + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_recovers_all_sound_records(packed):
    import gzip

    from linkloom.llm.warc import salvage

    payloads = [random.Random(i).randbytes(2000) for i in range(9)]
    members = [record(i, p) for i, p in enumerate(payloads)]
    if packed:
        members = [gzip.compress(m) for m in members]
    whole = b"".join(members)
    assert [r[0] for r in salvage(whole)] == ["record"] * 9
    rnd = random.Random(5)
    for _ in range(60):
        hit = rnd.randrange(9)
        at = sum(map(len, members[:hit])) + rnd.randrange(len(members[hit]) // 2)
        damaged = whole[:at] + rnd.randbytes(8) + whole[at + 8 :] if rnd.random() < 0.5 else whole[:at] + whole[at + rnd.randint(1, 30) :]
        out = list(salvage(damaged))
        found = {r[1]["warc-record-id"]: r[2] for r in out if r[0] == "record"}
        for i, payload in enumerate(payloads):
            if i != hit:
                assert found[f"<urn:{i}>"] == payload
        # damage to a field that no check covers leaves the record readable
        if payloads[hit] not in found.values():
            assert any(r[0] == "gap" and r[1] < r[2] for r in out)
    assert list(salvage(b"")) == []
    assert [r[0] for r in salvage(b"garbage")] == ["gap"]


def salvaged(data: bytes) -> list[tuple]:
    from linkloom.llm.warc import salvage

    return [(r[1]["warc-record-id"], r[2]) if r[0] == "record" else None for r in salvage(data)]


def test_salvage_decides_at_each_position():
    import gzip

    body = gzip.compress(b"<html>page</html>" * 50)
    payloads = [b"first", body, b"last" * 30_000]
    want = [(f"<urn:{i}>", p) for i, p in enumerate(payloads)]
    plain = [record(i, p) for i, p in enumerate(payloads)]
    assert salvaged(b"".join(plain)) == want
    # a damaged record with a gzip body in it, then sound ones
    hurt = plain[1].replace(b"urn:1", b"urn:9").replace(b"sha1:", b"sha1:A")
    assert [r for r in salvaged(plain[0] + hurt + plain[2]) if r] == [want[0], want[2]]
    # a first member over 64 KB without its magic
    noise = [random.Random(i).randbytes(100_000) for i in range(3)]
    members = [gzip.compress(record(i, p)) for i, p in enumerate(noise)]
    damaged = b"\0\0\0" + b"".join(members)[3:]
    assert [r for r in salvaged(damaged) if r][-2:] == [(f"<urn:{i}>", noise[i]) for i in (1, 2)]
    # plain records and members in one file, and a member cut short between them: nothing twice
    mixed = plain[0] + members[1] + plain[2] + members[0][:60_000] + record(7, b"seven") + members[2]
    assert [r for r in salvaged(mixed) if r] == [want[0], ("<urn:1>", noise[1]), want[2], ("<urn:7>", b"seven"), ("<urn:2>", noise[2])]


def test_salvage_keeps_records_before_a_fault():
    import gzip

    texts = [prose(80_000 + i, 150).encode() for i in range(6)]
    packed = gzip.compress(b"".join(record(i, t) for i, t in enumerate(texts)))
    want = [(f"<urn:{i}>", t) for i, t in enumerate(texts)]
    trailer = packed[:-8] + bytes([packed[-8] ^ 255]) + packed[-7:]
    assert salvaged(trailer) == [*want, None]
    # one member whose second half is of blocks of a type that does not exist
    first = zlib.compressobj(wbits=31)
    half = first.compress(b"".join(record(i, t) for i, t in enumerate(texts[:3]))) + first.flush(zlib.Z_FULL_FLUSH)
    assert salvaged(half + b"\xff" * 400) == [*want[:3], None]


# ---- 5: near duplicates

def shingles(text, words):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not parts:
        return frozenset()
    return frozenset(tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1)))


def component_of(items, words):
    sets = [(i, shingles(t, words)) for i, t in items if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def test_near_duplicates_equal_brute_force(spark, odd, none):
    from linkloom.llm.near_duplicates import near_duplicate_components

    items = [(r[0], r[1]) for r in odd_rows()]
    base = prose(50, 300).split(" ")
    for k in range(60):
        rnd = random.Random(k)
        words = list(base)
        for _ in range(rnd.randint(0, 40)):
            words[rnd.randrange(len(words))] = rnd.choice(["new", "other", "ALPHA"])
        items.append((100 + k, " ".join(words)))
    extra = [(i, t, "en", "web", None, "", "", "", "", "", "", "") for i, t in items[len(odd_rows()) :]]
    got = near_duplicate_components(odd.unionByName(spark.createDataFrame(extra, DOCS)), words=2).collect()
    want = component_of(items, 2)
    by_text = Counter((i, len(shingles(t, 2))) for i, t in items)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == by_text
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert near_duplicate_components(none).count() == 0


def test_cells_compare_each_pair_once():
    import pyarrow as pa

    import numpy as np

    from linkloom.llm.near_duplicates import CHUNK, N_HASHES, N_SKETCH, _first_shared, _in_question, _keys, _near_pairs, _settled

    same, zeros = bytes(N_SKETCH // 4), np.zeros((1, N_HASHES), "<u2")
    keys = _keys(zeros)[0]
    assert len(set(keys.tolist())) == N_HASHES
    table = pa.table({"rep": [1, 2, 3], "component": [1, 1, 3], "side": pa.array([2, 2, 2], pa.int32()), "n_shingles": [10, 10, 10], "sketch": [same] * 3, "signature": [zeros.tobytes()] * 3,
                      "key": [int(keys[0])] * 3})
    near = lambda t: sorted(zip(*(p.tolist() for p in _near_pairs(t))))
    assert near(table) == [(0, 2), (1, 2)] and _in_question(table).num_rows == 3
    whole = table.append_column("shingles", pa.array([np.arange(10, dtype=np.uint64).tobytes()] * 3))
    # one link is enough to join two components
    assert _settled(whole, 80).num_rows == 1
    unlike = table.append_column("shingles", pa.array([np.arange(k, k + 10, dtype=np.uint64).tobytes() for k in (0, 1, 3)]))
    assert _settled(unlike, 80).to_pylist() == [] and _settled(unlike, 65).to_pylist() == [{"a": 2, "b": 3}]
    later = table.set_column(table.schema.get_field_index("key"), "key", pa.array([int(keys[1])] * 3))
    assert _in_question(later).num_rows == 0
    table = table.set_column(2, "side", pa.array([0, 1, 1], pa.int32()))
    assert near(table) == [(0, 2)]

    rng = np.random.default_rng(4)
    for errors in range(28):
        one = rng.integers(0, 1 << 16, (1, N_HASHES)).astype("<u2")
        other = one.copy()
        other[0, rng.choice(N_HASHES, errors, replace=False)] += 1
        shared = np.flatnonzero(_keys(one)[0] == _keys(other)[0])
        # 27 differing components leave a chunk with one at most, so a key is shared
        assert len(shared) and _first_shared(one[0], other)[0] == shared[0]
        assert CHUNK * 14 == N_HASHES


# ---- 7: decontamination

def test_contamination_catches_edits_and_leaves_clean_texts(spark, odd, none):
    from linkloom.llm.decontamination import find_contamination, without_contamination

    item, long = prose(70, 25), prose(71, 120)
    bench = spark.createDataFrame([(1, item), (1, item), (2, long), (3, None), (4, ""), (5, "short"), (None, prose(72, 30))], "item_id long, text string")
    words = item.split(" ")
    edited = item.replace("a", "A", 3)[:40] + "z" + item[41:]
    planted = [(201, f"{prose(80, 40)}\n{item.upper()} {prose(81, 40)}"), (202, f"{prose(82, 40)} {edited} {prose(83, 10)}"),
               (203, f"{prose(84, 30)} {long[100:300]} {prose(85, 30)}"), (204, prose(72, 30)), (205, item), (206, " ".join(words[:12])), (207, prose(86, 2000))]
    docs = odd.unionByName(spark.createDataFrame([(i, t, "en", "web", None, *[""] * 7) for i, t in planted], DOCS))
    for block in (4_000_000, 100):
        got = {(r.doc_id, r.item_id) for r in find_contamination(docs, bench, block_chars=block).collect()}
        assert got == {(201, 1), (202, 1), (203, 2), (204, None), (205, 1)}
    left = without_contamination(docs, bench)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([r[0] for r in odd_rows()] + [206, 207])
    assert find_contamination(none, bench).count() == 0
    assert find_contamination(odd, bench.where("false")).count() == 0


def test_alignment_equals_full_table():
    import numpy as np

    from linkloom.llm.decontamination import _Index, _codes

    rnd = random.Random(2)
    for _ in range(40):
        pattern = "".join(rnd.choice("abcd") for _ in range(60))
        index = _Index([(1, pattern)], 4, 0.1, 120)
        chars = list(pattern)
        for _ in range(rnd.randint(0, 9)):
            at = rnd.randrange(len(chars))
            chars[at : at + rnd.randint(0, 1)] = rnd.choice(["", "x", "y"])
        before = rnd.randint(0, 20)
        text = "z" * before + "".join(chars) + "z" * rnd.randint(0, 5)
        row = [0] * (len(text) + 1)
        for letter in pattern:
            new = [row[0] + 1]
            for j, other in enumerate(text):
                new.append(min(row[j] + (letter != other), row[j + 1] + 1, new[j] + 1))
            row = new
        one = np.array([before])
        edits, _ = index.align(0, np.array(_codes(text)), np.array([0]), np.array([len(text)]), one, one)
        if min(row) <= index.edits[0]:
            assert edits[0] == min(row)


def fewest_edits(pattern: str, text: str) -> int:
    """Edits between the pattern and the part of the text nearest to it, by the full table."""
    row = [0] * (len(text) + 1)
    for letter in pattern:
        new = [row[0] + 1]
        for j, other in enumerate(text):
            new.append(min(row[j] + (letter != other), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("q,rate", [(4, 0.1), (6, 0.06)])
def test_contamination_equals_exhaustive_search(q, rate):
    from linkloom.llm.decontamination import _Index, _matches

    rnd = random.Random(q)
    for turn in range(12):
        letters = "ab" if turn % 3 == 0 else "abcdefgh"
        items = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(30, 60)))) for i in range(4)]
        items.append((4, "ab" * 20))
        texts = ["", "ab" * 90, items[0][1]]
        for _ in range(12):
            chars = list(rnd.choice(items)[1])
            for _ in range(rnd.randint(0, 5)):
                at = rnd.randrange(len(chars))
                chars[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "y"])
            around = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(2)]
            texts.append(around[0] + "".join(chars) + around[1])
        index, found = _Index(items, q, rate, 120), {}
        for number, segment, edits, _ in _matches(index, texts):
            found[number, segment] = min(edits, found.get((number, segment), edits))
        wanted = {(i, k): fewest_edits(item, text) for i, text in enumerate(texts) for k, (_, item) in enumerate(items)}
        assert found == {key: edits for key, edits in wanted.items() if edits <= index.edits[key[1]]}


def test_contamination_steps_do_not_change_candidates():
    from linkloom.llm.decontamination import _Index, _codes

    index = _Index([(1, "ab" * 60), (2, prose(90, 25)), (3, "the same again " * 8)], 5, 0.1, 120)
    codes = _codes("ab" * 400 + prose(90, 25) + "the same again " * 60 + prose(91, 200))

    def pairs(**sizes):
        return [tuple(r) for part in index.candidates(codes, **sizes) for r in part.tolist()]

    whole = pairs()
    assert len(whole) == len(set(whole)) > 100
    for positions, postings in ((7, 1 << 20), (100, 50), (1 << 20, 1), (333, 1000)):
        assert sorted(pairs(positions=positions, postings=postings)) == sorted(whole)


def test_contamination_takes_bounded_memory_on_periodic_text():
    import tracemalloc

    from linkloom.llm.decontamination import _Index, _matches

    index = _Index([(1, "ab" * 75)], 12, 0.06, 120)
    peaks = []
    for size in (100_000, 400_000):
        tracemalloc.start()
        assert sum(1 for _ in _matches(index, ["ab" * (size // 2)])) > size // 20
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0] + 30_000_000 and peaks[1] < 300_000_000


# ---- 8: chat

def test_maximal_chats(spark):
    from linkloom.llm.chat import maximal_conversations

    def chat(conv, *texts):
        return [(conv, k, "user" if k % 2 == 0 else None, t, 1) for k, t in enumerate(texts)]

    turns = (chat(1, "a", "b") + chat(2, "a", "b", "c") + chat(3, "a", "b", "c") + chat(4, "b") + chat(5, "a", None) + chat(6, "a", None, "x <| y")
             + chat(None, "z") + chat(7, *(str(i) for i in range(600))) + chat(8, *(str(i) for i in range(599))) + chat(9, "a", ""))
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, segment int")
    got = {(r.conv_id, r.segment): (r.n_turns, r.text) for r in maximal_conversations(df).collect()}
    assert set(got) == {(2, 0), (4, 0), (6, 0), (None, 0), (7, 0), (7, 1), (7, 2), (9, 0)}
    assert got[(7, 2)][0] == 88 and got[(7, 1)][1].startswith("<|user|>\n256\n")
    assert got[(6, 0)][1] == "<|user|>\na\n<|end|>\n<|unknown|>\n\n<|end|>\n<|user|>\nx < | y\n<|end|>\n"
    assert maximal_conversations(df.where("false")).count() == 0


# ---- 9: line templates

def test_recurring_templates_are_dropped(spark, odd, none):
    from linkloom.llm.templates import drop_recurring_lines

    people = [w + "sson" for w in WORDS]
    docs = [(300 + i, f"{prose(500 + i, 30)}\nShared on day {i} by {people[i]} this year\nAll rights are kept here\n{prose(600 + i, 30)}") for i in range(12)]
    docs.append((299, f"All rights are kept here\n{prose(700, 20)}"))
    docs += [(400 + i, f"{prose(800, 40)}\nOnly copies say this") for i in range(15)]
    table = odd.unionByName(spark.createDataFrame([(i, t, "en", "web", None, *[""] * 7) for i, t in docs], DOCS))
    cleaned = drop_recurring_lines(table, min_texts=10)
    assert set(cleaned.columns) == set(table.columns) | {"n_dropped"}
    got = {r.doc_id: r for r in cleaned.where("doc_id >= 299").collect()}
    assert got[299].n_dropped == 0 and got[299].text == docs[12][1]
    for i in range(12):
        lines = docs[i][1].split("\n")
        # the first text keeps the template that it is the first to show
        want = [lines[0], lines[1], lines[3]] if i == 0 else [lines[0], lines[3]]
        assert got[300 + i].text.split("\n") == want and got[300 + i].n_lines == 4
    assert all(got[400 + i].n_dropped == 0 for i in range(15))
    same = Counter((r[0], r[1]) for r in odd_rows())
    assert Counter((r.doc_id, r.text) for r in cleaned.where("doc_id < 299 or doc_id is null").collect()) == same
    assert drop_recurring_lines(none).count() == 0


def test_template_counts_do_not_depend_on_partitions(spark, odd):
    from linkloom.llm.templates import drop_recurring_lines

    a = rows(drop_recurring_lines(odd, min_texts=2), "doc_id", "n_dropped")
    assert a == rows(drop_recurring_lines(odd.repartition(7, F.rand()), min_texts=2), "doc_id", "n_dropped")


def test_passages_in_few_unrelated_texts_are_dropped(spark):
    from linkloom.llm.templates import drop_recurring_lines

    passages = {n: (" ".join(f"{w}{'abcdefghij'[n]}" for w in prose(9000 + n, size).split()), size)
                for n, size in ((2, 60), (3, 24), (4, 24), (5, 10), (9, 10), (1, 60))}
    docs, number = {}, 0
    for n, (line, _) in passages.items():
        for _ in range(n):
            docs[number] = f"{prose(20_000 + number, 90)}\n{line}\n{prose(30_000 + number, 40)}"
            number += 1
    body = f"{prose(40_000, 150)}\n{prose(40_001, 60)}".split(" ")
    near = {100 + k: " ".join(w if i != 7 + 40 * k else "changed" for i, w in enumerate(body)) for k in range(4)}
    # the same passage in near copies and in one unrelated text: the first text and its near copies keep it
    plus = {100 + i: f"{t}\n{passages[1][0]}z" for i, t in near.items()}
    plus[210] = f"{prose(50_000, 90)}\n{passages[1][0]}z"
    short = {300 + k: f"{prose(60_000 + k, 30)}\nAdvertisement\n}}\n{k}" for k in range(11)}
    table = spark.createDataFrame([*docs.items(), *near.items(), *short.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in drop_recurring_lines(table).collect()}
    number = 0
    for n, (line, _) in passages.items():
        for k in range(n):
            assert (line in got[number].text.split("\n")) == (k == 0), (n, k)
            assert got[number].n_dropped == (k > 0)
            number += 1
    assert all(got[i].n_dropped == 0 for i in near)
    assert [got[300 + k].text.split("\n")[1:] for k in range(11)] == [["Advertisement", "}", "0"]] + [["}", str(k)] for k in range(1, 11)]
    again = {r.doc_id: r.n_dropped for r in drop_recurring_lines(spark.createDataFrame([*plus.items()], "doc_id long, text string")).collect()}
    assert again == {200: 0, 201: 0, 202: 0, 203: 0, 210: 1}


def test_all_templates_of_a_leaf_are_generalised(spark):
    from linkloom.llm.templates import drop_recurring_lines

    def log(kind: int, k: int) -> str:
        tail = [f"{kind}{'abcdefghij'[j]}".translate(str.maketrans("0123456789", "klmnopqrst")) for j in range(10)]
        tail[3], tail[7] = "v" + "abcdefghijklmno"[k], "w" + "abcdefghijklmno"[k]
        return " ".join([f"2024-01-{k}", f"1{k}:00", str(k), *tail])

    kinds = 20
    docs = [(k, "\n".join([prose(70_000 + k, 40), *(log(kind, k) for kind in range(kinds))])) for k in range(12)]
    got = drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"), heads=3).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {k: kinds if k else 0 for k in range(12)}
