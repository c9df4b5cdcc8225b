"""Feature statistics, scalers and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.quantiles import exact_quantiles
from millrace.operators.features import minmax, zscore


def long_features(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, feature, value) from a wide table."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    return df.select(*keys, F.inline_outer(F.array(*cells)))


def scaler_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The fitted scaler as rows (feature, mean, std, min, max), population std: one wide
    aggregate, no shuffle of the data. Written as Parquet it is the saved scaler."""
    wide = df.agg(
        *[
            F.struct(
                F.avg(f).alias("mean"), F.stddev_pop(f).alias("std"), F.min(f).cast("double").alias("min"), F.max(f).cast("double").alias("max")
            ).alias(f)
            for f in features
        ]
    )
    return wide.select(F.inline_outer(F.array(*[F.struct(F.lit(f).alias("feature"), f"{f}.*") for f in features])))


def scaler_map(scaler: DataFrame) -> Column:
    """A scaler table as one map(feature -> statistics) scalar; its size is the feature count."""
    entry = F.struct("feature", F.struct("mean", "std", "min", "max"))
    return scaler.agg(F.map_from_entries(F.collect_list(entry)).alias("m")).scalar()


def standardize(df: DataFrame, features: Sequence[str], scaler: DataFrame, suffix: str = "_scaled") -> DataFrame:
    stats = scaler_map(scaler)
    return df.withColumns({f"{f}{suffix}": zscore(F.col(f), stats[f]["mean"], stats[f]["std"]) for f in features})


def minmax_scale(df: DataFrame, features: Sequence[str], scaler: DataFrame, suffix: str = "_scaled") -> DataFrame:
    stats = scaler_map(scaler)
    return df.withColumns({f"{f}{suffix}": minmax(F.col(f), stats[f]["min"], stats[f]["max"]) for f in features})


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, sample std, min, max and exact median per feature."""
    rows = long_features(df, features)
    basic = rows.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return basic.join(exact_quantiles(rows, ["feature"], "value", {"median": 0.5}), "feature")


def outliers(df: DataFrame, features: Sequence[str], scaler: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Names of the features whose |z| exceeds the threshold. Features without statistics
    or with zero std are skipped."""
    stats = scaler_map(scaler)

    def name_if_outlier(f: str) -> Column:
        known = F.try_element_at(stats, F.lit(f))
        z = F.abs((F.col(f) - known["mean"]) / F.when(known["std"] > 0, known["std"]))
        return F.when(z > threshold, F.lit(f))

    return df.withColumn("outlier_features", F.array_compact(F.array(*[name_if_outlier(f) for f in features]))).withColumn(
        "has_outliers", F.size("outlier_features") > 0
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k")).select(F.struct("*")).scalar()
    return counts.withColumn("weight", totals["n"] / (totals["k"] * F.col("n")))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    return df.join(class_weights(df, label).select(label, F.col("weight").alias(name)), label)
