"""Token-id files with a minimal perfect hash index (operator 10).

`write_token_files` puts the ids of all documents, in ascending order of the document key,
into raw binary files: one file per range partition, ids as little-endian unsigned integers
of 2 bytes (4 where the vocabulary needs them), nothing else. `build_index` maps every
document key to (file, offset, ids, position in the whole corpus) by a minimal perfect hash:
keys are dealt by hash to index shards of about `KEYS_PER_SHARD`, and each shard stores the
bit levels of its hash function and, per slot, a 32-bit fingerprint and the place. `lookup`
finds any set of keys in constant time each, `read_ids` reads their payload by range reads.

Defined cases: a null text has no ids but the end id; a null key sorts first and is a key
like others; rows that repeat a key are told apart by their ordinal, in order of the text's
hash; an empty table gives empty files and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.files import create, open_random, task_suffix
from millrace.llm.tokens import PartEncoder
from millrace.session import materialize, scratch_path

KEYS_PER_SHARD = 200_000
READ_BYTES = 8 << 20
MAGIC = b"MPHIX001"
PLACE = np.dtype([("print", "<u4"), ("part", "<u4"), ("attempt", "<u8"), ("offset", "<u8"), ("ids", "<u8"), ("start", "<u8")])


@lru_cache(maxsize=1)
def encoder(tokenizer: str, dtype: str, special: bool = False) -> PartEncoder:
    return PartEncoder(tokenizer, dtype, special=special)


def id_type(tokenizer: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def payload_name(folder: str, part: int, attempt: int) -> str:
    return f"{folder}/tokens-{part:06d}-{attempt}.bin"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, special: bool = False) -> DataFrame:
    """Write the payload files; the stored manifest has key, ordinal, part, attempt, offset
    (bytes), ids and start (ids of all documents before)."""
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype).tobytes()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, offset, last, ordinal = encoder(tokenizer, dtype, special), None, 0, object(), 0
        context = TaskContext.get()
        for batch in batches:
            if out is None:
                out = create(payload_name(folder, context.partitionId(), context.taskAttemptId()))
            keys, lengths, ordinals = batch.column("key").to_pylist(), [], []
            for k, ids in zip(keys, enc.encode(batch.column("text").to_pylist()), strict=True):
                ordinal = ordinal + 1 if k == last else 0
                last = k
                out.write(ids + end)
                lengths.append(len(ids) + len(end))
                ordinals.append(ordinal)
            n = np.array(lengths, np.int64)
            offsets = offset + np.cumsum(n) - n
            offset += int(n.sum())
            width = len(end)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "ordinal": pa.array(ordinals, pa.int64()),
                "part": pa.array(np.full(len(n), context.partitionId(), np.int64)), "attempt": pa.array(np.full(len(n), context.taskAttemptId(), np.int64)),
                "offset": offsets, "ids": n // width,
            })
        if out is not None:
            out.close()
        enc.forget()

    manifest = materialize(rows.mapInArrow(write, f"key {kind}, ordinal long, part long, attempt long, offset long, ids long"), "token-manifest")
    # One row per payload file: few enough to be summed up in order by one task.
    before = manifest.groupBy("part").agg(F.sum("ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    width = np.dtype(dtype).itemsize
    return manifest.join(before, "part").withColumn("start", F.expr(f"before + offset div {width}")).drop("before")


# ---------------------------------------------------------------- the hash function


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    return (_mixed(h1 ^ _mixed(h2 + seed)) % np.uint64(size)).astype(np.int64)


def fingerprints(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mixed(h1 + (h2 << np.uint64(1))) >> np.uint64(32)).astype(np.uint32)


def build_levels(h1: np.ndarray, h2: np.ndarray, gamma: float = 2.0) -> list[np.ndarray]:
    """Bit levels: at each, a key alone on its spot is settled there, the others go on.
    The rank of a key's bit over all levels is its slot, so n keys use slots 0 to n - 1."""
    levels: list[np.ndarray] = []
    while len(h1):
        if len(levels) > 200:
            raise ValueError("two keys have the same 128-bit hash")
        size = max(64, int(gamma * len(h1)))
        spots = _spots(h1, h2, len(levels), size)
        alone = np.bincount(spots, minlength=size) == 1
        levels.append(alone)
        rest = ~alone[spots]
        h1, h2 = h1[rest], h2[rest]
    return levels


def find_slots(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Slot of each key; a key that is not in the set gets any slot, or -1."""
    slots, base, open_ = np.full(len(h1), -1, np.int64), 0, np.arange(len(h1))
    for level, bits in enumerate(levels):
        spots = _spots(h1[open_], h2[open_], level, len(bits))
        ranks = np.cumsum(bits) - 1 + base
        hit = bits[spots]
        slots[open_[hit]] = ranks[spots[hit]]
        base += int(bits.sum())
        open_ = open_[~hit]
    return slots


def pack_index(levels: list[np.ndarray], places: np.ndarray) -> bytes:
    head = MAGIC + struct.pack("<QI", len(places), len(levels)) + struct.pack(f"<{len(levels)}Q", *map(len, levels))
    return head + b"".join(np.packbits(x).tobytes() for x in levels) + places.tobytes()


def unpack_index(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    n, count = struct.unpack_from("<QI", data, 8)
    sizes, at, levels = struct.unpack_from(f"<{count}Q", data, 20), 20 + 8 * count, []
    for size in sizes:
        levels.append(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
        at += (size + 7) // 8
    return levels, np.frombuffer(data, PLACE, n, at)


def _hashed(keys: DataFrame, shards: int) -> DataFrame:
    """128 bits of hash for (key, ordinal) and the index shard."""
    return keys.withColumns(
        {"h1": F.xxhash64("key", "ordinal"), "h2": F.xxhash64(F.lit("second"), "ordinal", "key")}
    ).withColumn("shard", F.pmod(F.col("h2"), F.lit(shards)))


def build_index(manifest: DataFrame, folder: str) -> DataFrame:
    """Write one index file per shard; the stored directory has shard, path, keys, shards."""
    shards = max(1, -(-manifest.count() // KEYS_PER_SHARD))
    rows = _hashed(manifest, shards).select("shard", "h1", "h2", "part", "attempt", "offset", "ids", "start")

    def build(group: pa.Table) -> pa.Table:
        h1, h2 = (group.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        levels = build_levels(h1, h2)
        slots, places = find_slots(levels, h1, h2), np.zeros(len(h1), PLACE)
        places["print"][slots] = fingerprints(h1, h2)
        for name in ("part", "attempt", "offset", "ids", "start"):
            places[name][slots] = group.column(name).to_numpy()
        shard = group.column("shard")[0].as_py()
        path = f"{folder}/index-{shard:06d}-{task_suffix()}.mph"
        with create(path) as out:
            out.write(pack_index(levels, places))
        return pa.table({"shard": [shard], "path": [path], "keys": [len(h1)]})

    directory = rows.groupBy("shard").applyInArrow(build, "shard long, path string, keys long")
    return materialize(directory.withColumn("shards", F.lit(shards)), "token-index")


def lookup(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """Places of the rows (key, ordinal) of `keys`; a key that is not indexed has null places."""
    kind = keys.schema["key"].dataType.simpleString()
    first = directory.select("shards").first()
    shards = first["shards"] if first else 1
    wanted = _hashed(keys.select("key", "ordinal"), shards).join(directory.select("shard", "path"), "shard", "left")

    def find(group: pa.Table) -> pa.Table:
        path, out = group.column("path")[0].as_py(), group.select(["key", "ordinal"])
        h1, h2 = (group.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        if path is None:
            good, places = np.zeros(len(h1), bool), np.zeros(len(h1), PLACE)
        else:
            with open_random(path) as f:
                levels, stored = unpack_index(f.read())
            slots = find_slots(levels, h1, h2)
            places = stored[np.maximum(slots, 0)]
            good = (slots >= 0) & (places["print"] == fingerprints(h1, h2))
        for name in ("part", "attempt", "offset", "ids", "start"):
            out = out.append_column(name, pa.array(places[name].astype(np.int64), mask=~good))
        return out

    return wanted.groupBy("shard").applyInArrow(find, f"key {kind}, ordinal long, part long, attempt long, offset long, ids long, start long")


def read_ids(places: DataFrame, folder: str, dtype: str, with_ids: bool = False) -> DataFrame:
    """Payload of each place, read in the order of the files by ranges of up to `READ_BYTES`
    (or one document): key, ordinal, start, n_tokens, ids_crc32, and the raw ids if asked."""
    kind = places.schema["key"].dataType.simpleString()
    width = np.dtype(dtype).itemsize
    schema = f"key {kind}, ordinal long, start long, n_tokens long, ids_crc32 long" + ", raw binary" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy() for c in ("part", "attempt", "offset", "ids")}
            begins, ends = cols["offset"], cols["offset"] + cols["ids"] * width
            sums, raws, at, n = [], [], 0, batch.num_rows
            while at < n:
                to = at + 1
                while to < n and cols["attempt"][to] == cols["attempt"][at] and ends[to] - begins[at] <= READ_BYTES and begins[to] >= begins[at]:
                    to += 1
                if (own := payload_name(folder, int(cols["part"][at]), int(cols["attempt"][at]))) != name:
                    if handle is not None:
                        handle.close()
                    name, handle = own, open_random(own)
                base = int(begins[at])
                data = handle.read_at(int(ends[at:to].max()) - base, base)
                for i in range(at, to):
                    raw = data[begins[i] - base : ends[i] - base]
                    sums.append(zlib.crc32(np.frombuffer(raw, dtype).astype("<u4")))
                    raws.append(raw if with_ids else None)
                at = to
            out = {"key": batch.column("key"), "ordinal": batch.column("ordinal"), "start": batch.column("start"), "n_tokens": batch.column("ids"), "ids_crc32": pa.array(sums, pa.int64())}
            yield pa.RecordBatch.from_pydict(out | ({"raw": pa.array(raws, pa.binary())} if with_ids else {}))
        if handle is not None:
            handle.close()

    ordered = places.where("part is not null").repartition("part").sortWithinPartitions("part", "attempt", "offset")
    return ordered.mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, special: bool = False) -> DataFrame:
    """Write, index, look every document up again and read its ids back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, special=special)
    directory = build_index(manifest, folder)
    places = lookup(manifest.select("key", "ordinal"), directory)
    return read_ids(places, folder, id_type(tokenizer))
