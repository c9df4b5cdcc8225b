"""Centroid clustering over zone maps along a space-filling curve (operator 12).

Vectors become integers floor(scale * x), so every sum and distance is exact. They are ordered
along a Hilbert curve through a grid of four cells per component (borders at the mean and two
thirds of a deviation beside it, components of large variance first) and cut into blocks of
`BLOCK` consecutive vectors. A block is one stored row with a zone map: the least and largest
value of every component. A round reads the blocks. The squared distances from a vector to two
centroids differ by a linear function of the vector, whose least value over the box is a sum of
products with the box's sides: where that is positive, the second centroid is nearest to no
vector of the block. (This drops whatever distances to the nearest and farthest point of the box
would.) The others are its candidates, compared with all its vectors at once. A block with one
candidate compares nothing and takes its stored component sums. Tasks send counts and component sums of
clusters, so a round returns clusters times components numbers to the driver, never vectors.

The curve is cut by ranges of (curve key, hash of the id): copies of one vector spread over
tasks. The order of vectors within a block and the blocks themselves change no result.

Defined cases: vectors of another length than `dim`, null, or with null or non-finite components
take no part, and neither do those with a component of 2^17 or more, as distances would leave 64
bits. Repeated rows are vectors of their own. A null id has a hash like any other and comes last
in the choice of the first centroids; of equal ids the smaller vector comes first. With fewer
vectors than clusters each starts one. No vectors, no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.vectors import matrix
from millrace.session import materialize

BLOCK = 128
BITS = 2
LARGEST = float(1 << 17)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve, as rows of bytes in ascending order, of cells (n, dimensions)
    with coordinates below 2^bits: the turns of the sub-cubes are undone from the coarsest bit
    on, then the coordinates are Gray coded and their bits interleaved."""
    x = cells.astype(np.uint8).T.copy()  # a row per dimension
    dim = len(x)
    for level in range(bits - 1, 0, -1):
        below = np.uint8((1 << level) - 1)
        for i in range(dim):
            mirrored = (x[i] >> level) & 1 == 1
            swapped = np.where(mirrored, 0, (x[0] ^ x[i]) & below).astype(np.uint8)
            x[i] ^= swapped
            x[0] ^= np.where(mirrored, below, swapped)
    for i in range(1, dim):
        x[i] ^= x[i - 1]
    last = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        last ^= np.where((x[-1] >> level) & 1 == 1, np.uint8((1 << level) - 1), np.uint8(0))
    x ^= last
    digits = np.concatenate([(x >> level) & 1 for level in range(bits - 1, -1, -1)])
    return np.packbits(digits, axis=0).T


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector in the box."""
    norms = (centroids**2).sum(axis=1)
    kept = np.ones(len(centroids), bool)
    for i in range(len(centroids)):  # by how much j is farther than i, at least
        slope = 2 * (centroids[i] - centroids)
        kept &= np.minimum(low * slope, high * slope).sum(axis=1) + norms - norms[i] <= 0
    return np.flatnonzero(kept)


def squared_distances(x: np.ndarray, centroids: np.ndarray, largest: int) -> np.ndarray:
    """Exact squared distances (vectors, centroids). Products of doubles are exact while all
    sums stay below 2^53, which the largest component of both sides shows."""
    if x.shape[1] * (2 * largest) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def assign(block: dict, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number) and squared distance of the vectors of a block."""
    x, low, high = (np.frombuffer(block[c], np.int32).astype(np.int64) for c in ("x", "low", "high"))
    x = x.reshape(-1, centroids.shape[1])
    some = candidates(low, high, centroids)
    largest = int(max(np.abs(low).max(), np.abs(high).max(), np.abs(centroids[some]).max()))
    apart = squared_distances(x, centroids[some], largest)
    nearest = apart.argmin(axis=1)
    return some[nearest], apart[np.arange(len(x)), nearest]


def _moments(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each component: they shape the grid and change no result."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros(dim)
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            n, first, second = n + len(x), first + x.sum(axis=0), second + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": [n] * dim, "place": range(dim), "first": first, "second": second})

    sums = rows.select("x").mapInArrow(add, "n long, place long, first double, second double")
    held = sums.groupBy("place").agg(F.sum("n").alias("n"), F.sum("first").alias("first"), F.sum("second").alias("second")).orderBy("place").collect()
    n, first, second = (np.array([r[c] for r in held], np.float64) for c in ("n", "first", "second"))
    mean = first / np.maximum(n, 1)
    return mean, np.sqrt(np.maximum(second / np.maximum(n, 1) - mean**2, 0))


def zone_maps(rows: DataFrame, dim: int, scale: int) -> DataFrame:
    """Stored blocks of the vectors (id, x): ids, x (integers of 32 bits, vector by vector), the
    box (low, high) and the component sums."""
    mean, deviation = _moments(rows, dim)
    borders = mean[:, None] + np.outer(deviation, [-0.67, 0.0, 0.67])
    first = np.argsort(-deviation, kind="stable")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            cells = (x[:, :, None] >= borders[None]).sum(axis=2)[:, first]
            whole = np.floor(scale * x).astype(np.int32)
            keys = [k.tobytes() for k in hilbert_keys(cells, BITS)]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "curve": pa.array(keys, pa.binary()), "v": pa.array([v.tobytes() for v in whole], pa.binary())})

    kind = rows.schema["id"].dataType.simpleString()
    keyed = rows.select("id", "x").mapInArrow(place, f"id {kind}, curve binary, v binary").withColumn("spread", F.xxhash64("id"))
    dealt = keyed.repartitionByRange("curve", "spread").sortWithinPartitions("curve", "spread").select("id", "v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(held: pa.Table) -> pa.RecordBatch:
            out: dict[str, list] = {c: [] for c in ("ids", "x", "low", "high", "sums")}
            for at in range(0, held.num_rows, BLOCK):
                own = held.slice(at, BLOCK)
                raw = b"".join(own.column("v").to_pylist())
                x = np.frombuffer(raw, np.int32).reshape(-1, dim)
                out["ids"].append(own.column("id").to_pylist())
                for name, value in (("x", x), ("low", x.min(axis=0)), ("high", x.max(axis=0)), ("sums", x.sum(axis=0, dtype=np.int64))):
                    out[name].append(value.tobytes())
            types = {"ids": pa.list_(held.schema.field("id").type)}
            return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.binary())) for c, v in out.items()})

        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            full = held.num_rows // BLOCK * BLOCK
            if full:
                yield blocks(held.slice(0, full))
                held = held.slice(full)
        if held is not None and held.num_rows:
            yield blocks(held)

    return materialize(dealt.mapInArrow(cut, f"ids array<{kind}>, x binary, low binary, high binary, sums binary"), "zone-maps")


def first_centroids(rows: DataFrame, clusters: int, seed: int, scale: int) -> np.ndarray:
    """The vectors whose `seed:id` has the smallest hashes, in their order."""
    named = rows.select("x", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("hash"))
    held = named.orderBy(F.col("hash").asc_nulls_last(), "x").limit(clusters).collect()
    return np.floor(scale * np.array([r["x"] for r in held], np.float64)).astype(np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the mean components; empty ones stay."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                low, high = (np.frombuffer(block[c], np.int32).astype(np.int64) for c in ("low", "high"))
                some = candidates(low, high, centroids)
                if len(some) == 1:
                    counts[some[0]] += len(block["x"]) // (4 * dim)
                    sums[some[0]] += np.frombuffer(block["sums"], np.int64)
                    continue
                own, _ = assign(block, centroids)
                x = np.frombuffer(block["x"], np.int32).reshape(-1, dim)
                for c in np.unique(own):
                    counts[c] += int((own == c).sum())
                    sums[c] += x[own == c].sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(np.repeat(used, dim), pa.int32()), "place": pa.array(np.tile(np.arange(dim), len(used)), pa.int32()), "n": np.repeat(counts[used], dim), "total": sums[used].ravel()})

    parts = blocks.select("x", "low", "high", "sums").mapInArrow(add, "cluster int, place int, n long, total long")
    # Totals of all tasks may leave 64 bits, those of a task may not.
    whole = parts.groupBy("cluster", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for r in whole.collect():  # clusters times components
        out[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return out


def cluster_vectors(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    x = F.col("x")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST)) & (F.size(x) == dim)
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x")).where(F.coalesce(usable, F.lit(False)))
    kind = rows.schema["id"].dataType
    schema = StructType().add(key, kind)
    centroids = first_centroids(rows, clusters, seed, scale)
    if not len(centroids):
        none = rows.select(F.col("id").alias(key), F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
        return none.where(F.lit(False))
    blocks = zone_maps(rows, dim, scale)
    for _ in range(rounds):
        last, centroids = centroids, moved(blocks, centroids)
        if (last == centroids).all():  # a round that moves none would repeat itself
            break

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, apart = assign({c: batch.column(c)[i].as_py() for c in ("x", "low", "high")}, centroids)
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(i, 1).flatten(), pa.array(own, pa.int32()), pa.array(apart, pa.int64())], [key, "cluster", "distance"])

    placed = blocks.select("ids", "x", "low", "high").mapInArrow(place, schema.add("cluster", "integer").add("distance", "long"))
    placed = materialize(placed, "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = {c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in sums}
    of = lambda values: F.create_map(*(F.lit(v) for c in sorted(values) for v in (c, values[c])))[F.col("cluster")]
    return placed.select(key, "cluster", "distance", of(sums).cast("long").alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), of(digests).alias("centroid_sha256"))
