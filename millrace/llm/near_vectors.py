"""Near-duplicate vectors by spherical k-means cells (operator 5).

Copies of a vector are one class; classes are compared. Spherical k-means, fitted on a bounded
sample (`sample` rows with the smallest hash; the centres only steer the work), assigns every
class to its nearest centre's cell; the number of cells is that of the least cost. A pair of
classes in two cells i < j is compared in cell i: there the class of j comes as a guest if it
lies within the link angle of the plane between both centres, which every class with a link
into i does. So no link is lost. A cell of many members is cut into blocks, and each pair of
blocks is one task's cosine product; only link counts and a spanning forest leave it. One
vector per group is kept.

Defined cases: null, zero and non-finite vectors link with nothing; vectors of different
dimension are not linked; rows that repeat an id are one vector of the answer for linking, each
with its own row; rows without id link with nothing and have no component; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.vectors import matrix, usable
from millrace.session import materialize

BLOCK = 8_192
TILE = 1_024
MAX_CELLS = 1_024
# Moving a row costs about as much as this many products.
PAIRS_PER_ROW = 500
MOST_COPIES = 4


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centres; a centre without members takes the vector worst served."""
    x = _unit(x)
    rng = np.random.Generator(np.random.PCG64(seed))
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = x @ centres.T
        home, best = near.argmax(axis=1), near.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(norms < 1e-9)
        sums[empty] = x[np.argsort(best)[: len(empty)]]
        centres = _unit(sums)
    return centres


def visited_cells(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells, and whether at home: the home cell, and earlier cells that a link may reach."""
    near = x @ centres.T
    home = near.argmax(axis=1)
    gaps = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    reach = math.sqrt(1 - threshold * threshold) + 1e-9  # sine of the link angle
    own = near[np.arange(len(x)), home][:, None]
    guest = (own - near <= reach * gaps) & (np.arange(len(centres))[None, :] < home[:, None])
    rows, cells = np.nonzero(guest)
    return np.concatenate([np.arange(len(x)), rows]), np.concatenate([home, cells]), np.concatenate([np.ones(len(x), bool), np.zeros(len(rows), bool)])


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


class BlockLinks:
    """Link counts of the vectors of a block pair, and pairs that connect what is linked.

    A tile's cosines are first taken in single precision; pairs near or over the threshold are
    taken again in double. Where these are many, the tile is taken as a whole."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, copies: np.ndarray, threshold: float):
        self.x, self.ids, self.copies, self.threshold = x, ids, copies, threshold
        self.norm = np.linalg.norm(x, axis=1)
        self.unit = (x / self.norm[:, None]).astype(np.float32)
        self.degree = np.zeros(len(ids), np.int64)
        self.pairs: list[np.ndarray] = []

    def compare(self, left: np.ndarray, right: np.ndarray, both: bool) -> None:
        """All pairs of two lists of rows; `both`: count the links for the right side too."""
        for at in range(0, len(left) if len(right) else 0, TILE):
            rows = left[at : at + TILE]
            near = self.unit[rows] @ self.unit[right].T >= np.float32(self.threshold - 1e-4)
            if np.count_nonzero(near) > 64 * TILE:
                linked = (self.x[rows] @ self.x[right].T) / (self.norm[rows][:, None] * self.norm[right][None, :]) >= self.threshold
                linked &= self.ids[rows][:, None] != self.ids[right][None, :]
                self.degree[rows] += linked @ self.copies[right]
                if both:
                    self.degree[right] += linked.T @ self.copies[rows]
                self._connect(rows, right, linked)
            else:
                i, j = np.nonzero(near)
                i, j = rows[i], right[j]
                some = (np.einsum("ij,ij->i", self.x[i], self.x[j]) / (self.norm[i] * self.norm[j]) >= self.threshold) & (self.ids[i] != self.ids[j])
                i, j = i[some], j[some]
                np.add.at(self.degree, i, self.copies[j])
                if both:
                    np.add.at(self.degree, j, self.copies[i])
                self.pairs.append(np.column_stack([self.ids[i], self.ids[j]]))

    def _connect(self, rows: np.ndarray, right: np.ndarray, linked: np.ndarray) -> None:
        """Every linked vector of the tile with the smallest id that the tile's links reach."""
        top = np.iinfo(np.int64).max
        a, b = self.ids[rows], self.ids[right]
        while True:
            low_a = np.minimum(a, np.where(linked, b[None, :], top).min(axis=1))
            low_b = np.minimum(b, np.where(linked, low_a[:, None], top).min(axis=0))
            if (low_a == a).all() and (low_b == b).all():
                break
            a, b = low_a, low_b
        self.pairs += [np.column_stack([self.ids[rows], a]), np.column_stack([self.ids[right], b])]

    def forest(self) -> list[tuple[int, int]]:
        pairs = np.concatenate(self.pairs) if self.pairs else np.empty((0, 2), np.int64)
        return _forest(pairs[:, 0], pairs[:, 1])


def choose_centres(x: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Centres for n classes like the sample x: the number of cells (1, 2, 4, ...) of the least
    cost in products (pairs) and rows moved, both measured on the sample. Where vectors have few
    clusters, more cells save products but bring ever more guests: numbers that would move more
    than `MOST_COPIES` rows per class are left out. The links found are the same either way."""
    probe, best, least, k, over = _unit(x[:4_000]), None, np.inf, 1, 0
    while k <= min(MAX_CELLS, max(1, len(x) // 4)) and over < 2:
        centres = spherical_kmeans(x, k)
        _, cells, home = visited_cells(probe, centres, threshold)
        here = np.bincount(cells, minlength=k) / len(probe) * n
        own = np.bincount(cells[home], minlength=k) / len(probe) * n
        cost = (own * here).sum() + PAIRS_PER_ROW * (here * np.ceil(here / BLOCK)).sum()
        over = over + 1 if here.sum() > MOST_COPIES * n else 0
        if cost < least and not over:
            best, least = centres, cost
        k *= 2
    return best


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding", sample: int = 20_000) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x"))
    good = rows.where(F.col("id").isNotNull() & usable("x")).withColumn("hash", F.xxhash64("x")).withColumn("hash2", F.xxhash64(F.lit(1), "x"))
    members = good.select("id", "hash", "hash2")
    classes = good.groupBy("hash", "hash2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("x").alias("x")).withColumn("dim", F.size("x"))
    classes = materialize(classes, "vector-classes")
    parts = []
    for dim in sorted(r["dim"] for r in classes.select("dim").distinct().collect()):
        own = classes.where(F.col("dim") == dim)
        n = own.count()
        drawn = own.select("x", "hash").orderBy("hash").limit(sample).toArrow()
        centres = choose_centres(matrix(drawn.column("x"), dim), n, threshold)
        parts.append(_compare(own, dim, centres, threshold))
    empty = classes.sparkSession.createDataFrame([], "a long, b long, degree long")
    found = empty
    for part in parts:
        found = found.union(part)
    found = materialize(found, "vector-links")
    degrees = found.where("b is null").groupBy("a").agg(F.sum("degree").alias("others"))
    groups = components(found.where("b is not null").select("a", "b"))
    answer = classes.select("hash", "hash2", F.col("id").alias("class"), "copies")
    answer = answer.join(degrees, F.col("class") == F.col("a"), "left").join(groups, F.col("class") == F.col("node"), "left")
    answer = answer.select(
        F.col("hash").alias("h"), F.col("hash2").alias("h2"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component_id")
    )
    # Rows without a usable vector or id never meet the hot keys of the join.
    linked = members.join(answer, (F.col("hash") == F.col("h")) & (F.col("hash2") == F.col("h2"))).select("id", "n_links", "component_id")
    rest = rows.where(F.col("id").isNull() | ~usable("x")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(rest)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _compare(classes: DataFrame, dim: int, centres: np.ndarray, threshold: float) -> DataFrame:
    """(a, null, linked copies) per class and block, and (a, b, null) for the links of forests."""

    def assign(batches):
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            rows, cells, home = visited_cells(_unit(x), centres, threshold)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cells.astype(np.int64)), "home": pa.array(home), "id": batch.column("id").take(pa.array(rows)), "copies": batch.column("copies").take(pa.array(rows)), "x": batch.column("x").take(pa.array(rows))})

    kind = classes.schema["x"].dataType.simpleString()
    placed = materialize(classes.select("id", "copies", "x").mapInArrow(assign, f"cell long, home boolean, id long, copies long, x {kind}"), "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))  # a row per centre
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # Block b meets every block: pairs (first, second) with first <= second.
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("cell", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "home", "id", "copies", "x")

    def compare(group: pa.Table) -> pa.Table:
        ids, copies, home, block = (group.column(c).to_numpy() for c in ("id", "copies", "home", "block"))
        first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
        links = BlockLinks(matrix(group.column("x"), dim), ids, copies, threshold)
        own, guest = np.flatnonzero((block == first) & home), np.flatnonzero((block == first) & ~home)
        # Guests are compared with each other in a cell of their own.
        if first == second:
            links.compare(own, own, both=False)
            links.compare(own, guest, both=True)
        else:
            links.compare(own, np.flatnonzero(block == second), both=True)
            links.compare(guest, np.flatnonzero((block == second) & home), both=True)
        some, forest = np.flatnonzero(links.degree), links.forest()
        return pa.table({
            "a": pa.array(np.concatenate([ids[some], np.array([e[0] for e in forest], np.int64)]), pa.int64()),
            "b": pa.array([None] * len(some) + [e[1] for e in forest], pa.int64()),
            "degree": pa.array(links.degree[some].tolist() + [None] * len(forest), pa.int64()),
        })

    return dealt.groupBy("cell", "first", "second").applyInArrow(compare, "a long, b long, degree long")
