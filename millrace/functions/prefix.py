"""Running sums and ranks without sorting a whole group in one task.

A plain window over a group sorts that group in a single task. Here the caller
names a bucket that never decreases along the order. Bucket totals are a small
partial-aggregated table; their running sums are the offsets, and only rows of one
(group, bucket) are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.hashing import HASH_RANGE
from millrace.session import shuffle_width

BUCKET = "__bucket"
STRETCH = 1024


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def plain_key(key: str) -> Column:
    """The key as text that is never null: null has a text of its own, which no value has."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    sums: dict[str, Column],
    totals: bool = False,
) -> DataFrame:
    """Add, for each name in `sums`, `<name>_before`: the sum over earlier rows of the
    same group. With `totals`, also `<name>_total` over the whole group.

    No row is lost: null keys are a group, and a null bucket (a null order value) comes
    first. The window inside buckets and the join of the offsets use the same plain columns,
    so the rows are shuffled once. Bucket totals are summed up in two levels: stretches of
    `STRETCH` buckets side by side, then the stretches."""
    keys = list(keys)
    plain = [f"__k{i}" for i in range(len(keys))]
    spot = [*plain, BUCKET]
    base = df.withColumns(
        {
            BUCKET: F.coalesce(bucket.cast("double"), F.lit(float("-inf"))),
            **{p: plain_key(k) for p, k in zip(plain, keys, strict=True)},
            **{f"__{n}": c for n, c in sums.items()},
        }
    )
    stretch = F.when(F.col(BUCKET) > float("-inf"), F.floor(F.col(BUCKET) / STRETCH)).otherwise(F.lit(-(2**62)))
    per_bucket = base.groupBy(*spot).agg(*[F.sum(f"__{n}").alias(f"__{n}_b") for n in sums]).withColumn("__stretch", stretch)
    per_stretch = per_bucket.groupBy(*plain, "__stretch").agg(*[F.sum(f"__{n}_b").alias(f"__{n}_s") for n in sums])
    group = Window.partitionBy(*plain)
    far = per_stretch.select(
        *plain,
        "__stretch",
        *[F.coalesce(F.sum(f"__{n}_s").over(_before(group.orderBy("__stretch"))), F.lit(0)).alias(f"__{n}_far") for n in sums],
        *([F.sum(f"__{n}_s").over(group).alias(f"{n}_total") for n in sums] if totals else []),
    )
    near = _before(Window.partitionBy(*plain, "__stretch").orderBy(BUCKET))
    offsets = per_bucket.select(
        *spot, "__stretch", *[F.coalesce(F.sum(f"__{n}_b").over(near), F.lit(0)).alias(f"__{n}_near") for n in sums]
    ).join(far, [*plain, "__stretch"])
    offsets = offsets.select(
        *spot, *[(F.col(f"__{n}_far") + F.col(f"__{n}_near")).alias(f"__{n}_off") for n in sums], *([f"{n}_total" for n in sums] if totals else [])
    )
    inside = _before(Window.partitionBy(*spot).orderBy(*order))
    placed = base.withColumns({f"__{n}_in": F.coalesce(F.sum(f"__{n}").over(inside), F.lit(0)) for n in sums})
    out = placed.join(offsets, spot).withColumns({f"{n}_before": F.col(f"__{n}_off") + F.col(f"__{n}_in") for n in sums})
    return out.select(*df.columns, *[f"{n}_before" for n in sums], *([f"{n}_total" for n in sums] if totals else []))


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, name: str = "rank"
) -> DataFrame:
    """0-based position of each row in its group as `<name>`, and the group size as `<name>_total`."""
    ranked = prefix_sums(df, keys, order, bucket, {name: F.lit(1).cast("long")}, totals=True)
    return ranked.withColumnRenamed(f"{name}_before", name)


def hash_order_bucket(hash_col: Column, buckets: int = 4096) -> Column:
    """Bucket for rows ordered by a 32-bit hash: equal ranges are equally full."""
    return F.floor(hash_col / F.lit(HASH_RANGE // buckets))


def id_order_bucket(id_col: Column, width: int = 65536) -> Column:
    """Bucket for rows ordered by a unique integer id: at most `width` rows each."""
    return F.floor(id_col / F.lit(width))


def value_cuts(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Cut points that spread `value` evenly, from one mergeable sketch. They only balance
    the work: results are exact for any cuts."""
    n = buckets or min(8192, max(16, 4 * shuffle_width(df.sparkSession)))
    cuts = df.stat.approxQuantile(value, [i / n for i in range(1, n)], 1 / (2 * n)) or [0.0]
    return [-float("inf"), *sorted(set(cuts)), float("inf")]


def with_value_bucket(df: DataFrame, value: str, cuts: list[float], name: str) -> DataFrame:
    """Add `name`: the bucket of `value` by binary search over `cuts` in the JVM."""
    return Bucketizer(splits=cuts, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)
