"""Repeated strings by threshold-bounded interval expansion on a BWT (operator 1).

Every byte covered by a string of `length` bytes that also starts anywhere else is removed.

*Dealing.* A window of `length` bytes has as its key the smallest hash of the `GRAM`-byte
strings in it, so equal windows have equal keys. Consecutive windows of one key are a piece,
about 1.5 windows long. A key of one piece is done, unless its smallest hash is there in several
places; where several pieces of a key are all the same, their windows repeat. Only pieces that share a key and differ go on, each once.

*Expansion.* Pieces are sorted into a suffix array and its Burrows-Wheeler transform, bucket by
bucket of keys. Intervals of strings are extended backward breadth-first, from 7 bytes on, one
byte a level: the right border of an interval first met at a level is a border between suffixes
whose common prefix has that length. So common prefixes come out by increasing value, and the
expansion stops at `length`: suffixes whose border was not met share `length` bytes or more.

*Hot keys.* A key whose different pieces hold more than `HOT_BYTES`, as those of a large group of
near copies do, is split: its pieces are cut again by the smallest hash of longer strings (`LONGER`),
below the first key. Equal windows still have equal keys, what near copies share becomes equal
pieces, of which one goes on, and windows beside a difference get keys of their own. Only a key
that is still as large under the longest of these strings has its windows compared by a 128-bit
hash, counted before they are shuffled.

Tables between the steps are removed as soon as what reads them is stored.

Defined cases: a null text is empty; texts shorter than `length` keep all; repeated rows remove
each other like any copies; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.prefix import prefix_sums
from millrace.llm.words import mixed, stretches
from millrace.session import discard, materialize

GRAM = 32
LONGER = {32: 128, 128: 256}
MOST_WINDOWS = 4_096
BUCKET_BYTES = 1 << 20
HOT_BYTES = 2 << 20
SALTS = 16
CHUNK = 1 << 20
STRETCH_BYTES = 4 << 20
_BASE = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- pieces


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of all `gram`-byte strings, by doubling: a string's hash is made of those
    of its halves. `gram` is a power of two."""
    h = mixed(data.astype(np.uint64) + np.uint64(0x51ED270B))
    size = 1
    while size < gram:
        h = h[:-size] * _BASE + h[size:]
        size *= 2
    return mixed(h)


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def find_pieces(data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """First bytes, windows and keys of the pieces of texts laid end to end (`ends` are theirs),
    and whether the key's hash may be in several places of the piece."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    hashes, width = gram_hashes(data, gram), length - gram + 1
    keys = sliding_minimum(hashes, width)
    n = len(keys)
    valid = np.ones(n + 1, bool)
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    for e in ends[ends < len(data)].tolist():
        valid[max(0, e - length + 1) : min(e, n)] = False
        if e <= n:
            border[e] = True
    valid[n] = False
    border[1:n] |= (keys[1:] != keys[:-1]) | (valid[1:n] != valid[: n - 1])
    starts = np.flatnonzero(border[:n])
    sizes = np.diff(np.append(starts, n))
    good = valid[starts]
    starts, sizes = starts[good], sizes[good]
    if len(sizes) and sizes.max() > MOST_WINDOWS:  # repetitive text: cut, windows stay whole
        times = -(-sizes // MOST_WINDOWS)
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        starts = np.repeat(starts, times) + nth * MOST_WINDOWS
        sizes = np.minimum(np.repeat(sizes, times) - nth * MOST_WINDOWS, MOST_WINDOWS)
    # Nearly all keys are below this; a larger one counts as several.
    small = np.uint64(min(20 / width, 0.99) * 2.0**64)
    places = np.flatnonzero(hashes < small)
    low, high = np.searchsorted(places, starts), np.searchsorted(places, starts + sizes + width - 1)
    met = high - low
    at = np.repeat(low - (np.cumsum(met) - met), met) + np.arange(int(met.sum()))
    own = keys[starts]
    same = np.bincount(np.repeat(np.arange(len(starts)), met), weights=hashes[places[at]] == np.repeat(own, met), minlength=len(starts))
    return starts, sizes, own, (same > 1) | (own >= small)


def piece_hash(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from, to): texts of about `CHUNK` bytes together, or a stretch of
    one long text, overlapping the next by less than a window."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if len(t) > CHUNK:
            if i > at:
                yield at, i, 0, 0
            yield from ((i, i + 1, b, b + CHUNK) for b in range(0, len(t), CHUNK))
            at, held = i + 1, 0
        else:
            held += len(t)
            if held > CHUNK:
                yield at, i + 1, 0, 0
                at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts), 0, 0


def cut_texts(texts: list[bytes], length: int, gram: int = GRAM) -> Iterator[tuple[int, int, int, int, bool, int]]:
    """(text, first byte, windows, key, key in several places, hash of the piece) of all pieces."""
    for first, last, begin, to in _groups(texts):
        if to:
            raw = texts[first][begin : to + length - 1]
            ends = np.array([len(raw)])
        else:
            raw = b"".join(texts[first:last])
            ends = np.cumsum([len(t) for t in texts[first:last]])
        starts, sizes, keys, several = find_pieces(np.frombuffer(raw, np.uint8), ends, length, gram)
        own = np.searchsorted(ends, starts, "right")
        shift = begin - (ends[own] - np.diff(ends, prepend=0)[own])
        for i, s, n, k, m, d in zip((own + first).tolist(), starts.tolist(), sizes.tolist(), keys.view(np.int64).tolist(), several.tolist(), shift.tolist(), strict=True):
            yield i, s + d, n, k, m, piece_hash(raw[s : s + n + length - 1])


# ---------------------------------------------------------------- suffix array and expansion


def suffix_array(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Symbols (byte + 1, 0 behind each piece), suffix array, its inverse, the suffixes' first
    7 symbols, and the bytes before the end of the piece. The end of a piece is smaller than any byte and than that of a later one."""
    lengths = np.array([len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + np.int16(1)
    ends = np.cumsum(lengths) - 1
    text[ends] = 0
    n = len(text)
    left = np.repeat(ends, lengths).astype(np.int32) - np.arange(n, dtype=np.int32)  # bytes before the piece's end
    head = np.zeros(n, np.int64)
    for j in range(7):
        symbol = np.zeros(n, np.int16)
        symbol[: max(0, n - j)] = text[j:]
        symbol[left <= j] = 0
        head |= symbol.astype(np.int64) << (9 * (6 - j))
    number = np.where(left < 7, np.repeat(np.arange(1, len(pieces) + 1, dtype=np.int32), lengths), np.int32(0))
    order = np.lexsort((number, head)).astype(np.int32)
    del number, symbol
    new = np.ones(n, bool)
    sorted_head = head[order]
    new[1:] = (sorted_head[1:] != sorted_head[:-1]) | (left[order][1:] < 7)
    del sorted_head
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(new).astype(np.int32)[np.cumsum(new, dtype=np.int32) - 1]
    step = 7
    while True:
        single = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~single).astype(np.int32)  # places in groups of several suffixes
        if not len(open_):
            break
        own = order[open_]
        group, behind = rank[own], rank[own + step]
        inner = np.argsort(group.astype(np.int64) * n + behind, kind="stable")
        own, group, behind = own[inner], group[inner], behind[inner]
        order[open_] = own
        new[open_[1:]] = (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])
        new[open_[0]] = True
        starts = np.flatnonzero(new).astype(np.int32)
        rank[own] = starts[np.searchsorted(starts, open_, "right") - 1]
        step *= 2
    return text, order, rank, head, left


def shared_suffixes(pieces: list[bytes], length: int) -> np.ndarray:
    """Whether the `length` bytes from each byte on start elsewhere in the pieces too, by the
    breadth-first expansion; pieces end to end, each with one place for its end."""
    text, order, rank, head, left = suffix_array(pieces)
    n = len(order)
    bwt = text[order - 1]
    back = rank[order - 1]  # the suffix one symbol longer, for each
    # Borders between suffixes that differ in the first 7 symbols.
    first = head[order]
    del head, rank
    apart = np.ones(n + 1, bool)
    apart[1:n] = (first[1:] != first[:-1]) | ((first[1:] & 511) == 0)  # also: both end there
    common = np.full(n + 1, -1, np.int16)
    x = first[1:] ^ first[:-1]
    bits = np.frexp(np.maximum(x, 1).astype(np.float64))[1]  # position of the highest bit set
    # Rounding up to the next power of two only happens above bit 53, never across a symbol.
    inner = np.minimum(6 - (bits - 1) // 9, 6)
    common[1:n][apart[1:n]] = np.where(x == 0, np.minimum(left[order][1:], 6), inner)[apart[1:n]]
    common[[0, n]] = 0
    del first, x, bits, inner, apart, left
    known = common >= 0
    # Intervals of 7 symbols whose right border separates at the 7th.
    borders = np.flatnonzero(known)
    right = borders[common[borders] == 6]
    right = right[(right > 0) & (right < n)]
    low = borders[np.searchsorted(borders, right) - 1]
    high = right - 1
    for level in range(7, length):
        if not len(low):
            break
        size = high - low + 1
        one = size == 1
        own = low[one]
        own = own[bwt[own] > 0]
        lows, highs = [back[own]], [back[own]]
        if not one.all():
            many, size = low[~one], size[~one]
            at = np.repeat(many - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            kind = np.repeat(np.arange(len(many)), size) * 512 + bwt[at]
            some = bwt[at] > 0
            at, kind = at[some], kind[some]
            sort = np.argsort(kind, kind="stable")
            at, kind = at[sort], kind[sort]
            begin = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.empty(0, np.int32)
            lows.append(back[at[begin]])
            highs.append(back[at[np.append(begin[1:], len(kind)) - 1]] if len(kind) else begin)
        low, high = np.concatenate(lows), np.concatenate(highs)
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
        common[high + 1] = level
    alike = ~known  # border i lies between suffixes i - 1 and i
    found = np.zeros(n, bool)
    found[order] = alike[:n] | alike[1:]
    return found


# ---------------------------------------------------------------- the job


def _pieces(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ((b.slice(at, len(own)), own) for b in batches for at, own in stretches(b.column("data"), STRETCH_BYTES)):
            found = np.array(list(cut_texts([t or b"" for t in texts], length, gram)), np.int64).reshape(-1, 6).T
            at = pa.array(found[0])
            key = mixed(found[3].view(np.uint64) ^ batch.column("under").take(at).to_numpy().view(np.uint64)).view(np.int64) if gram > GRAM else found[3]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row").take(at), "start": found[1], "windows": found[2].astype(np.int32), "key": key, "several": found[4].astype(bool), "hash": found[5]})

    return rows.select("row", "under", "data").mapInArrow(cut, "row long, start long, windows int, key long, several boolean, hash long")


def _texts_of(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Texts of the wanted pieces (row, start, windows, key, hash, copies)."""
    held = wanted.groupBy(F.col("row").alias("own")).agg(F.collect_list(F.struct("start", "windows", "key", "hash", "copies")).alias("own_pieces"))
    met = rows.join(held, F.col("row") == F.col("own")).select("data", "own_pieces")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for raw, pieces in zip(batch.column("data").to_pylist(), batch.column("own_pieces").to_pylist(), strict=True):
                for p in pieces:
                    piece = raw[p["start"] : p["start"] + p["windows"] + length - 1]
                    if piece_hash(piece) == p["hash"]:  # else another row of the same hash
                        out.append((p["key"], p["hash"], p["copies"], piece))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(cols[0], pa.int64()), "hash": pa.array(cols[1], pa.int64()), "copies": pa.array(cols[2], pa.int64()), "piece": pa.array(cols[3], pa.binary())})

    return met.mapInArrow(take, "key long, hash long, copies long, piece binary").dropDuplicates(["key", "hash"])


def _expanded(pieces: DataFrame, length: int) -> DataFrame:
    """Marks of the repeated windows of each piece, by bucket of keys."""

    def expand(group: pa.Table) -> pa.Table:
        raws = group.column("piece").to_pylist()
        found, at, marks = shared_suffixes(raws, length), 0, []
        for raw in raws:
            marks.append(np.packbits(found[at : at + len(raw) - length + 1]).tobytes())
            at += len(raw) + 1
        out = group.select(["key", "hash"]).append_column("marks", pa.array(marks, pa.binary()))
        return out.filter(pa.array([any(m) for m in marks])).select(["key", "hash", "marks"])

    return pieces.groupBy("bucket").applyInArrow(expand, "key long, hash long, marks binary")


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """The same marks, by counting the hashes of single windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, own, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "hash", "piece")), strict=True):
                n = len(raw) - length + 1
                digests = np.frombuffer(b"".join(hashlib.blake2b(raw[i : i + length], digest_size=16).digest() for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict({"key": np.full(n, key), "hash": np.full(n, own), "place": np.arange(n, dtype=np.int64), "w1": digests[:, 0], "w2": digests[:, 1]})

    single = pieces.mapInArrow(windows, "key long, hash long, place long, w1 long, w2 long")
    several = single.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("w1").alias("v1"), F.col("w2").alias("v2"))
    met = single.join(several, (F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2")))
    return _joined(met.select("key", "hash", F.col("place").alias("start"), F.lit(1).alias("windows"), F.lit(None).cast("binary").alias("marks")))


def _joined(parts: DataFrame) -> DataFrame:
    """Marks of pieces from those of their parts (key, hash, start, windows, marks)."""
    held = parts.groupBy("key", "hash").agg(F.collect_list(F.struct("start", "windows", "marks")).alias("parts"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for own in batch.column("parts").to_pylist():
                bits = np.zeros(MOST_WINDOWS, bool)
                for p in own:
                    bits[p["start"] : p["start"] + p["windows"]] |= True if p["marks"] is None else np.unpackbits(np.frombuffer(p["marks"], np.uint8), count=p["windows"]).astype(bool)
                marks.append(np.packbits(bits).tobytes())
            yield batch.select(["key", "hash"]).append_column("marks", pa.array(marks, pa.binary()))

    return held.mapInArrow(mark, "key long, hash long, marks binary")


def _split(hot: DataFrame, length: int, gram: int) -> tuple[DataFrame, list[DataFrame]]:
    """Marks of the pieces of hot keys, from pieces cut by longer strings below the same key, and
    the stored tables they are read from."""
    longer = LONGER.get(gram, length)
    if longer > 3 * length // 4:
        return _counted(hot, length), []
    named = hot.select("key", "hash", "piece").withColumn("row", F.xxhash64("key", "hash"))
    below = named.select("row", F.col("key").alias("under"), F.col("piece").alias("data"))
    parts = repeated_pieces(below, length, longer)
    back = named.select("key", "hash", F.col("row").alias("own"))
    return _joined(parts.join(back, F.col("row") == F.col("own")).select("key", "hash", "start", "windows", "marks")), [parts]


def covered(size: int, starts: list[int], windows: list[int], marks: list[bytes | None], length: int) -> np.ndarray:
    """Which bytes the repeated windows cover; without marks all windows of a piece repeat."""
    turn = np.zeros(size + 1, np.int64)
    for s, n, m in zip(starts, windows, marks, strict=True):
        if m is None:
            turn[s] += 1
            turn[s + n + length - 1] -= 1
        else:
            hit = np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8), count=min(n, 8 * len(m)))) + s
            np.add.at(turn, hit, 1)
            np.add.at(turn, hit + length, -1)
    return np.cumsum(turn[:size]) > 0


def repeated_pieces(rows: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """Stored pieces with repeated windows: row, start, windows, marks (null: all windows). Rows
    hold row, data and under: windows are compared below one value of that."""
    pieces = materialize(_pieces(rows, length, gram), "text-pieces")
    keys = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least"), F.max("hash").alias("most"), F.max("several").alias("several")).where("n > 1 or several")
    differ = (F.col("least") != F.col("most")) | (F.col("n") == 1)
    shared = materialize(pieces.join(keys.select("key", differ.alias("differ")), "key"), "shared-pieces")
    discard(pieces)
    same = shared.where("not differ").select("row", "start", "windows", F.lit(None).cast("binary").alias("marks"))
    classes = shared.where("differ").groupBy("key", "hash").agg(F.count(F.lit(1)).alias("copies"), F.first("row").alias("row"), F.first("start").alias("start"), F.first("windows").alias("windows"))
    classes = materialize(classes, "piece-classes")

    # Keys are dealt to buckets by their bytes, in the order of the keys.
    sizes = classes.groupBy("key").agg(F.sum(F.col("windows") + length).alias("bytes"))
    small = sizes.where(F.col("bytes") <= HOT_BYTES)
    dealt = prefix_sums(small, [], [F.col("key")], F.shiftright("key", 48), {"bytes": F.col("bytes")})
    dealt = materialize(dealt.select("key", F.floor(F.col("bytes_before") / BUCKET_BYTES).alias("bucket")), "key-buckets")
    texts = materialize(_texts_of(rows, classes, length), "piece-texts")
    marks = _expanded(texts.join(dealt, "key"), length)
    spent = [shared, classes, dealt, texts]
    if not sizes.where(F.col("bytes") > HOT_BYTES).isEmpty():
        more, stored = _split(texts.join(dealt, "key", "left_anti"), length, gram)
        marks, spent = marks.union(more), spent + stored
    # A piece with copies repeats whole; such classes are met under salts, as some have very many.
    spread = F.pmod(F.xxhash64("row", "start"), F.lit(SALTS).cast("long"))
    several = classes.where("copies > 1").select("key", "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    open_ = shared.where("differ")
    copied = open_.withColumn("salt", spread).join(several, ["key", "hash", "salt"]).select("row", "start", "windows", F.lit(None).cast("binary").alias("marks"))
    marked = marks.join(classes.where("copies = 1").select("key", "hash", "row", "start", "windows"), ["key", "hash"]).select("row", "start", "windows", "marks")
    found = materialize(same.union(copied).union(marked), "repeated-pieces")
    for table in spent:
        discard(table)
    return found


def remove_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of `docs`: key, n_bytes, n_removed, n_spans, kept_sha256. With `with_text`
    also kept_text (without what a cut leaves of a character; null stays null) and all other
    columns as the struct `others`."""
    other = [F.struct(*(c for c in docs.columns if c != text)).alias("others")] if with_text else []
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *other).withColumn("row", F.xxhash64("key", "text"))
    found = repeated_pieces(rows.select("row", F.lit(0).cast("long").alias("under"), F.col("text").cast("binary").alias("data")), length)
    spans = found.groupBy(F.col("row").alias("own")).agg(F.collect_set(F.struct("start", "windows", "marks")).alias("spans"))
    met = rows.join(spans, F.col("row") == F.col("own"), "left").select("key", "text", "spans", *(["others"] if with_text else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in ((b.slice(at, len(own)), own) for b in batches for at, own in stretches(b.column("text"), STRETCH_BYTES)):
            out: list[tuple] = []
            for t, own in zip(texts, batch.column("spans").to_pylist(), strict=True):
                raw, removed, runs = (t or "").encode(), 0, 0
                size = len(raw)
                if own:
                    gone = covered(size, [s["start"] for s in own], [s["windows"] for s in own], [s["marks"] for s in own], length)
                    removed, runs = int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((size, removed, runs, hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "ignore") if with_text and removed else t))
            cols = list(zip(*out, strict=True)) or [(), (), (), (), ()]
            data = {"key": batch.column("key")} | {c: pa.array(v, pa.int64()) for c, v in zip(("n_bytes", "n_removed", "n_spans"), cols, strict=False)} | {"kept_sha256": pa.array(cols[3], pa.string())}
            yield pa.RecordBatch.from_pydict(data | ({"kept_text": pa.array(cols[4], pa.string()), "others": batch.column("others")} if with_text else {}))

    schema = StructType([rows.schema["key"]]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    return met.mapInArrow(cut, schema.add("kept_text", "string").add(rows.schema["others"]) if with_text else schema)
