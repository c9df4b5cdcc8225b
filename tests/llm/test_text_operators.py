"""Operators on documents against brute force, with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from millrace.llm import byte_bpe, jaccard, packing, quality, sharding, suffixes, token_files, tokens
from millrace.llm.tokens import PartEncoder
from millrace.llm.words import chunks as words_chunks
from millrace.llm.words import word_hashes
from tests.llm.cases import SCHEMA, documents, frame, sentence

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [(r[0], r[1] or "") for r in documents()]


def test_parts_give_the_librarys_ids(tokenizer):
    rng = random.Random(5)
    signs = [" ", "\n", "\t", "a", "B", "1", "'s", "'", ".", "é", " ", "\x1c", " ", "日", "ª", "²", "😀", "!!"]
    some = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(5000)] + [t for _, t in texts()] + [sentence(i, 50) for i in range(50)]
    got = PartEncoder(BPE, keep=40).encode(some)
    for text, ids, whole in zip(some, got, tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == whole.ids, text


def expected_ids(tokenizer):
    return [(k, [*tokenizer.encode(t, add_special_tokens=False).ids, 0]) for k, t in texts()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(docs, empty, tokenizer):
    got = token_files.token_files(docs, BPE).collect()
    want = expected_ids(tokenizer)
    assert sorted((str(r.key), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), len(i), crc(i)) for k, i in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.key for r in sorted(got, key=lambda r: r.start)]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    assert token_files.token_files(empty, BPE).count() == 0


def test_perfect_hash_finds_keys_and_refuses_others(spark, docs, tmp_path):
    rng = np.random.default_rng(1)
    h1, h2, o1, o2 = (rng.integers(0, 2**64, 20_000, dtype=np.uint64) for _ in range(4))
    levels = token_files.build_levels(h1, h2)
    assert sorted(token_files.find_slots(levels, h1, h2)) == list(range(20_000))
    places = np.zeros(20_000, token_files.PLACE)
    places["print"][token_files.find_slots(levels, h1, h2)] = token_files.fingerprints(h1, h2)
    again, stored = token_files.unpack_index(token_files.pack_index(levels, places))
    slots = token_files.find_slots(again, o1, o2)
    assert not ((slots >= 0) & (stored["print"][np.maximum(slots, 0)] == token_files.fingerprints(o1, o2))).any()
    folder = f"file://{tmp_path}/tokens"
    manifest = token_files.write_token_files(docs, folder, BPE)
    directory = token_files.build_index(manifest, folder)
    asked = spark.createDataFrame([(11, 0), (11, 1), (11, 2), (99, 0), (None, 1)], "key long, ordinal long")
    found = {(r.key, r.ordinal): r.ids for r in token_files.lookup(asked, directory).collect()}
    assert found[(11, 0)] == found[(11, 1)] > 1000 and found[(11, 2)] is None and found[(99, 0)] is None and found[(None, 1)] > 0
    raw = token_files.read_ids(token_files.lookup(asked, directory), folder, "<u2", with_ids=True).collect()
    assert len(raw) == 3 and all(len(r.raw) == 2 * r.n_tokens for r in raw)


def test_packing(docs, empty, tokenizer):
    got = packing.pack(docs, BPE, with_ids=True).collect()
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[(str(r.key), r.doc_tokens)].append(r)
        assert crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 and len(r.ids) == 4 * r.length
    want = expected_ids(tokenizer)
    assert sum(r.length for r in got) == sum(len(i) for _, i in want)
    for k, ids in want:
        lengths = collections.defaultdict(list)
        for r in by_doc[(str(k), len(ids))]:
            assert np.frombuffer(r.ids, "<u4").tolist() in [i[r.start : r.start + r.length] for j, i in want if str(j) == str(k)]
            lengths[r.start].append(r.length)
        at, end = 0, {0}
        while end - {len(ids)}:  # the pieces of a document cover it, cut anywhere
            at = min(end)
            assert at in lengths
            end = (end - {at}) | {at + n for n in lengths[at]}
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty, BPE).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan_uses_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, [1, 3, 50, 10**9, 10, 200][seed], 65)
    counts[0] = 0
    if seed == 4:
        counts[:40] = 0
    plan, used = packing.plan_packing(counts)
    for combo, repeats in plan:
        assert 63 <= sum(combo) <= 64 and repeats > 0
        np.add.at(used, list(combo), repeats)
    assert (used == counts).all()


def test_packing_fills_complementary_lengths():
    counts = np.zeros(257, np.int64)
    counts[[40, 216, 100, 78, 78]] = [500, 500, 300, 600, 600]
    plan, stream = packing.plan_packing(counts)
    assert sum(r for _, r in plan) == 500 + 300 and not stream.any()


def test_least_squares_against_another_solver():
    """Projected gradient steps, many of them, reach no smaller residual; both are non-negative."""
    rng = np.random.default_rng(6)
    for trial in range(12):
        a = rng.integers(0, 3, (rng.integers(2, 9), rng.integers(2, 20))).astype(float)
        b = rng.integers(0, 60, len(a)).astype(float)
        x = packing.nonnegative_least_squares(a, b, 200)
        y, step = np.zeros(a.shape[1]), 1 / max(1e-9, np.linalg.norm(a, 2) ** 2)
        for _ in range(60_000):
            y = np.maximum(0, y - step * (a.T @ (a @ y - b)))
        assert (x >= 0).all() and np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-4 * (1 + np.linalg.norm(b)), trial


@pytest.mark.parametrize("words", [[598], [3], [698, 398], [340, 341, 342], [1500, 200]])
def test_lengths_that_nothing_complements_fill_their_sequences(spark, words):
    """Texts of some lengths only: sequences are at least 95 % full, and the ids are exact."""
    rng = random.Random(len(words))
    rows = [(i, " ".join(rng.choice(["a", "b", "the"]) for _ in range(words[i % len(words)]))) for i in range(900)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), BPE, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(BPE)
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}
    parts, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        parts[r.key].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: [x for _, own in sorted(p) for x in own] for k, p in parts.items()} == ids
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(map(len, ids.values())) >= 0.95 * 1024 * (len(sequences) - 1)


def test_pieces_of_awkward_texts_are_cut_too(docs, monkeypatch, tokenizer):
    """Everything goes through the stream: ids stay exact."""
    monkeypatch.setattr(packing, "SLACK", 1 << 20)
    got = packing.pack(docs, BPE, with_ids=True).collect()
    assert sum(r.length for r in got) == sum(len(i) for _, i in expected_ids(tokenizer))
    assert all(crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32 for r in got)


def test_byte_bpe(docs, empty):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    got = byte_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    want = []
    for k, t in texts():
        ids = enc.encode_ordinary(t)
        want.append((str(k), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted((str(r.key), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert byte_bpe.encode_decode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_long_words():
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    rng = random.Random(3)
    words = ["".join(rng.choices("abeEnrstio", k=rng.randint(40, 120))) for _ in range(30)] + ["a" * 900, "日本" * 60, "the" * 90]
    for word, (ids, n, decoded) in zip(words, byte_bpe.coder(RANKS, public_tokenizers.PATTERN).encode(words), strict=True):
        assert list(map(int, ids.split(b","))) == enc.encode_ordinary(word) and n == len(enc.encode_ordinary(word)) and decoded == word.encode()


def test_seams_of_stretches(spark, docs, monkeypatch, tokenizer):
    """What is taken at once is shrunk, so that texts cross every seam."""
    monkeypatch.setattr(tokens, "STRETCH", 100)
    rows = [t for _, t in texts()]
    for special in (False, True):
        tokenizer_ = Tokenizer.from_file(BPE)
        tokenizer_.encode_special_tokens = not special
        got = PartEncoder(BPE, keep=7, special=special).encode(rows)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [tokenizer_.encode(t, add_special_tokens=False).ids for t in rows]
    duck = byte_bpe.DuckCoder(RANKS, public_tokenizers.PATTERN, keep=5)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    for at in range(0, len(rows), 2):
        for t, (ids, n, decoded) in zip(rows[at : at + 2], duck.encode(rows[at : at + 2]), strict=True):
            want = enc.encode_ordinary(t)
            assert (ids, n, decoded) == (",".join(map(str, want)).encode(), len(want), t.encode())
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", 50)
    assert byte_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).agg({"n_tokens": "sum"}).first()[0] == sum(len(enc.encode_ordinary(t)) for t in rows)
    whole, counts = jaccard.gram_hashes(rows, 5)
    monkeypatch.setattr(jaccard, "chunks", lambda data: words_chunks(data, 40))
    again, same = jaccard.gram_hashes(rows, 5)
    assert (whole == again).all() and (counts == same).all()


def test_parts_of_texts():
    """Words and the signs behind them; other parts stay whole; places follow the texts."""
    split = tokens.split_parts(["a b, b, a", "b", "x  y"[:1], "été! 日本, 1, ... c"])
    words, signs = tokens.split_signs(split.parts)
    pairs = dict(zip(split.parts.to_pylist(), zip(words.to_pylist(), signs.to_pylist(), strict=True), strict=True))
    assert pairs == {"b,": ("b", ","), "a": ("a", ""), "日本,": ("日本,", ""), "1,": ("1,", ""), "...": ("...", ""), "c": ("c", "")}
    every = [*split.parts.to_pylist(), *split.heads]
    assert [every[i] for i in split.own] == ["a", "b,", "b,", "a", "b", "x", "été!", "日本,", "1,", "...", "c"] and split.first.tolist() == [0, 4, 5, 6]


def test_external_shuffle(spark, docs, empty, tmp_path):
    shuffled = sharding.external_shuffle(docs, shards=4, bucket_bytes=20_000)
    got = shuffled.collect()
    assert sorted((str(r.key), r.text or "") for r in got) == sorted((str(k), t) for k, t in texts())
    assert all(r["size"] == 16 + len((r.text or "").encode()) and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got)
    counts = collections.Counter(r.shard for r in got)
    assert set(counts) == {0, 1, 2, 3} and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    again = sharding.external_shuffle(docs.repartition(5), shards=4, bucket_bytes=20_000).collect()
    assert sorted((str(r.key), r.text or "", r.shard, r.slot) for r in again) == sorted((str(r.key), r.text or "", r.shard, r.slot) for r in got)
    folder = sharding.write_shards(shuffled, f"file://{tmp_path}/shards")
    assert spark.read.parquet(folder).count() == len(got)
    assert sharding.external_shuffle(empty).count() == 0
    few = sharding.external_shuffle(docs.limit(3), shards=40).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]


# ------------------------------------------------------------ repeated strings


def brute_repeats(rows, length):
    raws = [(k, (t or "").encode()) for k, t in rows]
    seen = collections.Counter(r[i : i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for k, r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(r, np.uint8)[~gone].tobytes()
        out.append((str(k), len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [4 << 20, 900])
def test_repeats(spark, docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_BYTES", hot)
    got = suffixes.remove_repeats(docs, with_text=True).collect()
    assert sorted((str(r.key), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats([(r[0], r[1]) for r in documents()], 400)
    assert all(r.others.key == "k" and r.others.row == 1 and (r.kept_text is None) == (r.key == 4) for r in got)
    assert suffixes.remove_repeats(empty).count() == 0


def test_a_hot_key_at_its_real_size(spark, monkeypatch):
    """A large group of near copies: its keys exceed a bucket and are split by longer strings;
    no window is left to the count of hashes."""

    def never(*_):
        raise AssertionError("windows counted by hash")

    monkeypatch.setattr(suffixes, "_counted", never)
    rng, base = random.Random(8), sentence(900, 330)[:2000]
    rows = []
    for i in range(5000):
        text = list(base)
        for _ in range(rng.choice([0, 1, 3, 6])):
            text[rng.randrange(len(text))] = rng.choice("abcdefgh")
        rows.append((i, "".join(text)))
    keys = collections.Counter()
    for i, start, windows, key, _, digest in suffixes.cut_texts([t.encode() for _, t in rows], 400):
        keys[key] += windows + 400
    assert max(keys.values()) > suffixes.HOT_BYTES
    raws = [t.encode() for _, t in rows]
    seen = collections.Counter(hash(r[a : a + 400]) for r in raws for a in range(len(r) - 399))
    want = []
    for i, r in enumerate(raws):
        gone = np.zeros(len(r) + 1, np.int64)
        for a in range(len(r) - 399):
            if seen[hash(r[a : a + 400])] > 1:
                gone[a] += 1
                gone[a + 400] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        want.append((str(i), int(gone.sum()), hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()))
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r.key), r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_seams_of_long_texts(spark, docs, monkeypatch):
    """Texts longer than what is taken at once: stretches, cut runs of windows, small buckets."""
    for name, value in (("CHUNK", 700), ("MOST_WINDOWS", 64), ("BUCKET_BYTES", 3000)):
        monkeypatch.setattr(suffixes, name, value)
    got = suffixes.remove_repeats(docs).collect()
    assert sorted((str(r.key), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats([(r[0], r[1]) for r in documents()], 400)


def test_repeats_of_planted_passages(spark):
    shared = sentence(77, 120)
    rows = [(i, sentence(100 + i, 60) + " " + (shared if i % 3 == 0 else sentence(500 + i, 90)) + sentence(300 + i, 40)) for i in range(30)]
    rows += [(100, shared[:399]), (101, shared[10:410]), (102, "ab" * 800), (103, "x" + "ab" * 300)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r.key), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 400)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc", bytes(range(256))])
@pytest.mark.parametrize("length", [8, 9, 25])
def test_expansion(alphabet, length):
    rng = random.Random(len(alphabet) * 100 + length)
    for _ in range(60):
        base = bytes(rng.choices(alphabet, k=rng.randint(1, 120)))
        pieces = []
        for _ in range(rng.randint(1, 6)):
            piece = bytearray(base[rng.randint(0, len(base) // 2) :] if rng.random() < 0.7 else bytes(rng.choices(alphabet, k=rng.randint(1, 90))))
            if piece and rng.random() < 0.6:
                piece[rng.randrange(len(piece))] = rng.choice(alphabet)
            pieces.append(bytes(piece))
        seen = collections.Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        want = [x for p in pieces for x in [*(i <= len(p) - length and seen[p[i : i + length]] > 1 for i in range(len(p))), False]]
        assert suffixes.shared_suffixes(pieces, length).tolist() == want


def test_pieces_hold_every_window_under_one_key():
    raws = [(sentence(i, 400) + "z" * (700 * i)).encode() for i in range(4)] + [b"", b"short", b"q" * 9000]
    keys = collections.defaultdict(set)
    count = collections.Counter()
    for i, start, windows, key, _, _ in suffixes.cut_texts(raws, 400):
        count[i] += windows
        for a in range(start, start + windows):
            keys[raws[i][a : a + 400]].add(key)
    assert all(len(k) == 1 for k in keys.values())
    assert all(count[i] == max(0, len(r) - 399) for i, r in enumerate(raws))


# ------------------------------------------------------------ Jaccard join


def brute_groups(rows, n=5, percent=80):
    sets = collections.defaultdict(list)
    sizes = []
    for k, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
        sizes.append((k, len(grams)))
        if k is not None:
            sets[k].append(grams)
    group = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if group[a] < group[b] and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                    group[b], changed = group[a], True
    return sorted((str(k), s, group.get(k)) for k, s in sizes)


def groups_of(df):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in df.collect())


def test_jaccard(docs, empty):
    assert groups_of(jaccard.similar_groups(docs)) == brute_groups([(r[0], r[1]) for r in documents()])
    assert jaccard.similar_groups(empty).count() == 0


def test_jaccard_sizes_chains_and_common_passages(spark):
    rng = random.Random(9)
    rows, key = [], 0
    boiler = sentence(1000, 40).split()
    for size in [5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 120]:
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(size + 4)]
        for cut in range(0, max(2, size // 4)):
            rows.append((key := key + 1, " ".join(base[cut:] + [f"n{key}x{i}" for i in range(rng.randint(0, 2))])))
        rows.append((key := key + 1, " ".join(base + boiler)))
    for i in range(40):  # a passage that many texts share
        rows.append((key := key + 1, " ".join(boiler + [f"u{i}a{j}" for j in range(rng.randint(0, 60))])))
    rng.shuffle(rows)
    assert groups_of(jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute_groups(rows)


@pytest.mark.parametrize("boundary", [0, 9, 40])
def test_jaccard_boundary_changes_nothing(spark, monkeypatch, boundary):
    rng = random.Random(boundary)
    rows = []
    for i in range(60):
        words = [f"g{i // 4}w{j}" for j in range(6 + 2 * (i // 4))]
        if words and rng.random() < 0.7:
            words[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    assert groups_of(jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_groups(rows)


def test_word_hashes():
    text = b" one two\tone\x0btwo  three\n"
    starts, hashes = word_hashes(np.frombuffer(text, np.uint8))
    assert [text[s:].split()[0] for s in starts] == [b"one", b"two", b"one", b"two", b"three"]
    assert hashes[0] == hashes[2] != hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


# ------------------------------------------------------------ quality


def junk(seed, n):
    return " ".join(w + "$$$" for w in sentence(seed, n).split())


def test_quality(spark, empty):
    rows = [(i, "\n".join(sentence(10 * i + j, 20) for j in range(1 + i % 5))) if i % 3 else (i, sentence(i, 12) + "\n" + "\n".join(junk(i + j, 25) for j in range(1 + i % 4))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(100)], "doc_id long, quality int")
    field = quality.fit_quality(docs, labels)
    got = {r.doc_id: r.score for r in quality.score_quality(docs, field).collect()}
    assert len(got) == 150 and all((got[i] >= 0.5) == (i % 3 != 0) for i in range(100, 150))
    odd = quality.score_quality(frame(spark), field)
    assert odd.columns[:9] == frame(spark).columns and odd.count() == len(documents())
    assert all(0 <= r.score <= 1 for r in odd.collect())
    assert quality.score_quality(empty, field).count() == 0
    none = quality.fit_quality(docs, labels.where("quality = 1"))
    assert all(r.score == 0.5 for r in quality.score_quality(docs, none).collect())
    assert all(r.score == 0.5 for r in quality.score_quality(docs, quality.fit_quality(docs, labels.limit(0))).collect())
    with pytest.raises(ValueError):
        quality.score_quality(docs.withColumnRenamed("doc_id", "score"), field)


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(2)
    unary, moves, per_text = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([4, 1, 3, 1])
    got, counts = quality._passes(unary, moves, per_text)
    want, pairs, at = [], np.zeros((2, 2)), 0
    for n in per_text:
        total, good, own = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> t) & 1 for t in range(n)]
            w = np.exp(sum(unary[at + t] * (y[t] - 0.5) for t in range(n)) + sum(moves[y[t], y[t + 1]] for t in range(n - 1)))
            total += w
            good += w * np.array(y)
            for t in range(n - 1):
                own[y[t], y[t + 1]] += w
        want += list(good / total)
        pairs += own / total
        at += n
    assert np.allclose(got, want) and np.allclose(counts, pairs)


def test_features_do_not_depend_on_the_batch():
    some = [t for _, t in texts()]
    base, size, per_text = quality.line_features(some)
    alone = [quality.line_features([t]) for t in some]
    assert np.allclose(base, np.concatenate([a[0] for a in alone])) and (size == np.concatenate([a[1] for a in alone])).all()
    assert per_text.tolist() == [t.count("\n") + 1 for t in some]
