"""Table profiles, fingerprints, fallback rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import numeric_columns

DISTINCT_BITS = 14  # 16,384 registers: about 0.8 % standard error


def dataset_metadata(df: DataFrame, version: str) -> DataFrame:
    """One row: rows, columns, names, missing cells, version."""
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
        missing.alias("missing"),
        F.lit(version).alias("version"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column in one pass, as (column, nulls, rows)."""
    wide = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"__{c}") for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("nulls")) for c in df.columns])
    return wide.select(F.inline(cells), "rows")


def fingerprint_sum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows and the sum of exact row digests: the same in any row order. A row's digest
    is the first 60 bits of the md5 over the text of its cells, each with its length before it,
    so no digits are cut, and null, NaN and infinite cells have a text of their own."""
    columns = list(columns or numeric_columns(df))
    cell = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    row = F.conv(F.substring(F.md5(F.concat(*map(cell, columns))), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("fingerprint"))


def fingerprint_rows(df: DataFrame) -> DataFrame:
    """Order-free fingerprint over whole rows: row count and the sum of row hashes."""
    return df.agg(
        F.count("*").alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("string").alias("fingerprint")
    )


def fallback_fill(primary: DataFrame, fallback: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every primary and every fallback row: primary values where present, missing ones from the
    fallback, tagged by where the row came from ('primary', 'filled' or 'fallback'). A primary
    row without a fallback stays as it is."""
    left = fallback.select(key, *[F.col(c).alias(f"__fb_{c}") for c in columns], F.lit(True).alias("__other"))
    right = primary.select(key, *columns, F.lit(True).alias("__present"))
    joined = left.join(right, key, "full")
    any_null = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
    return joined.select(
        key,
        *[F.coalesce(F.col(c), F.col(f"__fb_{c}")).alias(c) for c in columns],
        F.when(F.col("__present").isNull(), "fallback").when(any_null & F.col("__other").isNotNull(), "filled").otherwise("primary").alias("source"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, column and a mergeable sketch (HLL) of its distinct values. Stored per chunk, the
    sketches of any chunks merge without reading the rows again. Nulls are not counted."""
    wide = df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_BITS)).alias(f"__{c}") for c in columns])
    return wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{c}").alias("sketch")) for c in columns])))


def sketched_distinct(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, column and the estimated number of distinct values over all sketches of a key."""
    return sketches.groupBy(*keys, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Chunks stacked by column name; columns missing in a chunk become null."""
    out = chunks[0]
    for chunk in chunks[1:]:
        out = out.unionByName(chunk, allowMissingColumns=True)
    return out
