"""Null handling and per-batch filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import single_row


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def impute_global_mean(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    mean = single_row(df.agg(F.avg(column).alias("mean")))["mean"]
    return df.withColumn(name or column, F.coalesce(column, mean))


def impute_batch_mean(df: DataFrame, column: str, batch: str, name: str | None = None) -> DataFrame:
    """Fill with the mean of the row's own batch; an all-null batch stays null.

    A partial aggregate and a join rather than a window: no batch is gathered in one task.
    Rows without a batch are a batch of their own."""
    means = df.groupBy(F.col(batch).alias("__batch")).agg(F.avg(column).alias("__mean"))
    filled = df.join(means, F.col(batch).eqNullSafe(F.col("__batch")), "left")
    return filled.withColumn(name or column, F.coalesce(column, "__mean")).drop("__mean", "__batch")


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(columns))


def clamped_sqrt(value: Column, floor: float = 0.001) -> Column:
    """Square root after replacing missing and non-positive values by `floor`."""
    return F.sqrt(F.when((value > 0) & ~F.isnan(value), value).otherwise(F.lit(floor)))


def process_batches(df: DataFrame, batch: str, first: str = "f1", second: str = "f2") -> DataFrame:
    """The standard batch step: batch-mean imputation, clamped square root, their product."""
    out = impute_batch_mean(df, first, batch, f"{first}_processed")
    out = out.withColumn(f"{second}_sqrt", clamped_sqrt(F.col(second)))
    return out.withColumn("interaction", F.col(f"{first}_processed") * F.col(f"{second}_sqrt"))


def quantile_band(df: DataFrame, chunk: str, above: str, below: str, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Rows above the chunk's low quantile of one column and below its high quantile of
    another, both strict. A chunk holds at most its fixed row count, so the exact
    percentile aggregate is bounded."""
    bands = df.groupBy(chunk).agg(
        F.percentile(above, F.lit(low)).alias("__low"), F.percentile(below, F.lit(high)).alias("__high")
    )
    return df.join(bands, chunk).where((F.col(above) > F.col("__low")) & (F.col(below) < F.col("__high"))).drop("__low", "__high")
