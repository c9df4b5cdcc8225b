"""Approximate nearest neighbours by collision counting (operator 2).

Vectors are dealt to blocks. In a block, each of `functions` random projections has a sorted
array of the projections of its vectors. A query puts a window around its own projection in
every array; vectors inside collide with it. Windows grow by virtual rehashing (radius R, then
R * ratio, ...), counting only what each growth adds. Vectors with at least `threshold`
collisions are verified by their exact distance. A block stops when its k-th verified distance
is within R, as any closer vector collides that often with high probability, or when all are
verified. The best k of all blocks are kept. Queries meet every block in groups of
`QUERY_BLOCK`, so neither side is ever whole in one task or on the driver.

A vector at distance R collides on one projection with probability P(|N(0,1)| <= width / 2);
the threshold lies three standard deviations below its expected count, so one that near is
missed in about one of a thousand cases, and nearer ones less often.

Defined cases: null, zero and non-finite vectors and rows without id take no part; a repeated
id counts once, at its smallest distance (as a query with its smallest vector); vectors of
another dimension than the query's are no candidates; ties go to the smaller id. Other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.vectors import matrix, usable

BLOCK = 16_384
QUERY_BLOCK = 2_048


def projections(dim: int, functions: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, functions))


def collision_threshold(functions: int, width: float) -> int:
    p = math.erf(width / 2 / math.sqrt(2))
    return max(1, math.floor(functions * p - 3 * math.sqrt(functions * p * (1 - p))))


class SortedProjections:
    """The sorted arrays of a block."""

    def __init__(self, x: np.ndarray, lines: np.ndarray, width: float):
        self.x, self.lines, self.width = x, lines, width
        values = (x @ lines).T
        self.order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(values, self.order, axis=1)
        self.threshold = collision_threshold(lines.shape[1], width)

    def nearest(self, q: np.ndarray, ids: np.ndarray, own: int, k: int, radius: float, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and row numbers of the k nearest found, ties to smaller ids."""
        centre, n = q @ self.lines, len(self.x)
        counts = np.zeros(n, np.int32)
        open_ = ids != own
        low = high = None
        rows, dists = np.empty(0, np.int64), np.empty(0)
        while True:
            reach = radius * self.width / 2
            new_low = np.array([np.searchsorted(v, c - reach) for v, c in zip(self.values, centre, strict=True)])
            new_high = np.array([np.searchsorted(v, c + reach, "right") for v, c in zip(self.values, centre, strict=True)])
            if low is None:
                low = high = new_low
            added = [o[a:b] for o, a, b in zip(self.order, new_low, low, strict=True)] + [o[a:b] for o, a, b in zip(self.order, high, new_high, strict=True)]
            counts += np.bincount(np.concatenate(added), minlength=n).astype(np.int32)
            low, high = new_low, new_high
            fresh = np.flatnonzero((counts >= self.threshold) & open_)
            if len(fresh):
                open_[fresh] = False
                rows = np.concatenate([rows, fresh])
                dists = np.concatenate([dists, np.sqrt(((self.x[fresh] - q) ** 2).sum(axis=1))])
                best = np.lexsort((ids[rows], dists))
                keep, seen = [], set()
                for i in best:
                    if ids[rows[i]] not in seen:
                        seen.add(ids[rows[i]])
                        keep.append(i)
                        if len(keep) == k:
                            break
                rows, dists = rows[keep], dists[keep]
            if (len(rows) == k and dists[-1] <= radius) or not open_.any():
                return dists, rows
            radius *= ratio


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", functions: int = 64, width: float = 2.719, ratio: float = 1.4, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable("x"))
    rows = rows.withColumn("dim", F.size("x"))
    queries = rows.where("asks").groupBy("id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x"))
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("asks"), F.col("id"))).alias("q"))
    # A row per dimension; each side is repeated for every block of the other.
    held = sizes.collect()
    blocks, parts = (F.create_map(*(F.lit(v).cast("long") for r in held for v in (r["dim"], max(1, -(-r[name] // size)))))[F.col("dim").cast("long")] if held else F.lit(1).cast("long") for name, size in (("n", BLOCK), ("q", QUERY_BLOCK)))
    seeded = F.xxhash64(F.lit(seed), "id")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = rows.select(F.pmod(seeded, blocks).alias("block"), each(parts).alias("part"), "dim", "id", "x")
    right = queries.select(each(blocks).alias("block"), F.pmod(seeded, parts).alias("part"), F.col("dim").alias("dim"), F.col("id").alias("query"), F.col("x").alias("asked"))

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and asked.num_rows:
            dim = block.column("dim")[0].as_py()
            x, ids = matrix(block.column("x"), dim), block.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            index, ids = SortedProjections(x[order], projections(dim, functions, seed), width), ids[order]
            # The first radius: a small part of the spread of the projections.
            start = max(1e-6, float(index.values.std()) / 8)
            for own, q in zip(asked.column("query").to_numpy(), matrix(asked.column("asked"), dim), strict=True):
                dists, found = index.nearest(q, ids, own, k, start, ratio)
                out += [(own, i, d) for d, i in zip(dists, ids[found], strict=True)]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    keys = ("dim", "block", "part")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
