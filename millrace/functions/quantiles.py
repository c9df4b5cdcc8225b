"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.prefix import value_cuts, with_value_bucket
from millrace.session import materialize


def value_counts(df: DataFrame, keys: Sequence[str], value: str, **sums: Column) -> DataFrame:
    """Stored: keys, value (`__v`, double), how many rows have it (`__n`), and further aggregates of
    these rows. What is computed from values alone then reads this table, and the rows only once."""
    number = df.withColumn("__v", F.col(value).cast("double"))
    counts = number.groupBy(*keys, "__v").agg(F.count("*").alias("__n"), *[c.alias(name) for name, c in sums.items()])
    return materialize(counts, "value-counts")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    buckets: int | None = None,
) -> DataFrame:
    """One row per group with the linearly interpolated quantiles named in `probs`.

    The built-in exact percentile keeps every distinct value of a group in one task.
    Here values are counted and stored, the bucket holding each wanted rank is found from bucket
    totals, and only the rows of those buckets are ordered.
    """
    return counted_quantiles(value_counts(df, keys, value), keys, probs, buckets)


def counted_quantiles(stored: DataFrame, keys: Sequence[str], probs: dict[str, float], buckets: int | None = None) -> DataFrame:
    """`exact_quantiles` from `value_counts`; nulls take no part."""
    keys = list(keys)
    present = stored.select(*keys, "__v", "__n").where(F.col("__v").isNotNull())
    counts = with_value_bucket(present, "__v", value_cuts(present, "__v", buckets), "__b")

    group = Window.partitionBy(*keys)
    spans = (
        counts.groupBy(*keys, "__b")
        .agg(F.sum("__n").alias("__bn"))
        .withColumn("__total", F.sum("__bn").over(group))
        .withColumn(
            "__start",
            F.coalesce(F.sum("__bn").over(group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    low = {n: F.floor(F.lit(p) * (F.col("__total") - 1)) for n, p in probs.items()}
    high = {n: F.ceil(F.lit(p) * (F.col("__total") - 1)) for n, p in probs.items()}

    def holds(rank, first, size):
        return (rank >= first) & (rank < first + size)

    wanted = reduce(
        lambda a, b: a | b,
        [holds(r, F.col("__start"), F.col("__bn")) for r in [*low.values(), *high.values()]],
    )
    picked = spans.where(wanted).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__b").alias("__kb"), "__start", "__total"
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col("__b") == F.col("__kb")],
    )
    inside = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.join(picked, same).withColumn(
        "__first", F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    )

    def at(rank):
        return F.max(F.when(holds(rank, F.col("__first"), F.col("__n")), F.col("__v")))

    ends = placed.groupBy(*keys).agg(
        F.max("__total").alias("__total"),
        *[at(low[n]).alias(f"__lo_{n}") for n in probs],
        *[at(high[n]).alias(f"__hi_{n}") for n in probs],
    )

    def between(name: str, p: float):
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        position = F.lit(p) * (F.col("__total") - 1)
        return (lo + (hi - lo) * (position - F.floor(position))).alias(name)

    return ends.select(*keys, *[between(n, p) for n, p in probs.items()])
