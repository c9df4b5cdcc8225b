"""Reproducible splits, folds and samples: membership is a function of the row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.functions.prefix import hash_order_bucket, rank_in_group
from millrace.functions.selection import edge_rows


def random_split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, name: str = "split") -> DataFrame:
    """Tag rows 'train' or 'test' by hash of the key: no shuffle, and a later job
    derives the same split from the key alone."""
    return df.withColumn(
        name, F.when(key_hash(*key) % 1000 < round(test_share * 1000), "test").otherwise("train")
    )


def hash_rank(df: DataFrame, key: Sequence[str], groups: Sequence[str] = (), name: str = "rank", salt: str = "") -> DataFrame:
    """0-based position in hash order within each group, and the group size as `<name>_total`.
    A group of any size is ranked in parallel because hash order is cut into equal ranges."""
    parts = [F.col(k) for k in key] + ([F.lit(salt)] if salt else [])
    hashed = df.withColumn("__hash", key_hash(*parts))
    order = [F.col("__hash"), *[F.col(k) for k in key]]
    return rank_in_group(hashed, groups, order, hash_order_bucket(F.col("__hash")), name).drop("__hash")


def stratified_split(df: DataFrame, key: Sequence[str], label: str, test_share: float = 0.2, name: str = "split") -> DataFrame:
    """Exactly round(test_share * n) test rows in every class."""
    ranked = hash_rank(df, key, [label], "__rank")
    cut = F.round(F.lit(test_share) * F.col("__rank_total"))
    return ranked.withColumn(name, F.when(F.col("__rank") < cut, "test").otherwise("train")).drop("__rank", "__rank_total")


def stratified_folds(df: DataFrame, key: Sequence[str], label: str, k: int = 5, name: str = "fold") -> DataFrame:
    """Shuffled k folds; fold sizes within a class differ by at most one."""
    ranked = hash_rank(df, key, [label], "__rank")
    return ranked.withColumn(name, (F.col("__rank") % k).cast("int")).drop("__rank", "__rank_total")


def exact_sample(df: DataFrame, key: Sequence[str], share: float, name: str = "sampled", salt: str = "") -> DataFrame:
    """Flag exactly floor(share * n) rows, chosen by hash order without replacement."""
    ranked = hash_rank(df, key, (), "__rank", salt)
    chosen: Column = F.col("__rank") < F.floor(F.lit(share) * F.col("__rank_total"))
    return ranked.withColumn(name, chosen).drop("__rank", "__rank_total")


def rows_of_saved_split(df: DataFrame, saved_keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is in a saved id set."""
    return df.join(saved_keys.select(*key), list(key), "left_semi")


def dev_sample(df: DataFrame, key: str, rows: int = 1000, development: bool = True) -> DataFrame:
    """The first `rows` rows by integer key in development, everything otherwise."""
    return edge_rows(df, [], key, rows, latest=False) if development else df


def align_counts(x: DataFrame, y: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many keys of the two sides match, and how many are on one side only."""
    left = x.select(*key, F.lit(1).alias("__x"))
    right = y.select(*key, F.lit(1).alias("__y"))
    return left.join(right, list(key), "full_outer").agg(
        F.count_if(F.col("__x").isNotNull() & F.col("__y").isNotNull()).alias("matched"),
        F.count_if(F.col("__y").isNull()).alias("x_only"),
        F.count_if(F.col("__x").isNull()).alias("y_only"),
    )
