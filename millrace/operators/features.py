"""Versioned feature sets, encodings and per-row feature statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.prefix import rank_in_group
from millrace.functions.scalars import lookup, single_row
from millrace.operators.cleaning import impute_global_mean
from millrace.session import materialize, shuffle_width

# Type label and marker of each feature version.
TYPE_LABELS = {
    "1.": "basic_scaling",
    "2.": "standardized_with_engineering",
    "3.": "minmax_with_experimental",
}
DEFAULT_LABEL = "fallback_default"
MARKERS = {"1.": "v1_basic", "2.": "v2_advanced", "3.": "v3_experimental"}
DEFAULT_MARKER = "default"


def _fit(df: DataFrame, a: str, b: str) -> Column:
    """Mean, population std, min and max of both columns as one scalar subquery."""
    return single_row(
        df.agg(
            *[
                f(c).alias(f"{n}_{c}")
                for c in (a, b)
                for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
            ]
        )
    )


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """A zero std divides by one."""
    return (value - mean) / F.when(std == 0, 1.0).otherwise(std)


def minmax(value: Column, low: Column, high: Column) -> Column:
    """A zero range gives zero."""
    return F.when(high == low, 0.0).otherwise(F.try_divide(value - low, high - low))


def features_v1(a: str, b: str) -> dict[str, Column]:
    return {f"{a}_v1": F.col(a) * 2, f"{b}_v1": F.col(b) + 1}


def features_v2(a: str, b: str, fit: Column) -> dict[str, Column]:
    x, y = F.col(a), F.col(b)
    return {
        f"{a}_v2": zscore(x, fit[f"mean_{a}"], fit[f"std_{a}"]),
        f"{b}_v2": zscore(y, fit[f"mean_{b}"], fit[f"std_{b}"]),
        "feature_ratio": F.try_divide(x, y + 0.001),
        "feature_product": x * y,
        "feature_polynomial": x * x + y * y,
    }


def features_v3(a: str, b: str, fit: Column) -> dict[str, Column]:
    x, y = F.col(a), F.col(b)
    return {
        f"{a}_v3": minmax(x, fit[f"min_{a}"], fit[f"max_{a}"]),
        f"{b}_v3": minmax(y, fit[f"min_{b}"], fit[f"max_{b}"]),
        f"{a}_squared": x * x,
        f"{b}_sqrt": F.sqrt(F.abs(y)),
        "feature_log_ratio": F.log1p(F.abs(x)) / F.log1p(F.abs(y) + 1),
    }


def features_default(a: str, b: str) -> dict[str, Column]:
    return {"feature_default": F.col(a) + F.col(b)}


def versioned_features(df: DataFrame, version: str, a: str, b: str) -> DataFrame:
    """Feature set chosen by the version prefix, on the mean-imputed first column."""
    filled = impute_global_mean(df, a)
    prefix = version[:2]
    if prefix == "1.":
        columns = features_v1(a, b)
    elif prefix == "2.":
        columns = features_v2(a, b, _fit(filled, a, b))
    elif prefix == "3.":
        columns = features_v3(a, b, _fit(filled, a, b))
    else:
        columns = features_default(a, b)
    return filled.withColumns({**columns, "version_marker": F.lit(MARKERS.get(prefix, DEFAULT_MARKER))})


def dispatch_versions(df: DataFrame, version: str, a: str, b: str) -> DataFrame:
    """Per-row form: each row gets the two leading features and the label of its own version."""
    filled = impute_global_mean(df, a)
    fit = _fit(filled, a, b)
    sets = {"1.": features_v1(a, b), "2.": features_v2(a, b, fit), "3.": features_v3(a, b, fit)}
    fallback = [*features_default(a, b).values(), F.lit(None).cast("double")]

    def choose(pick, otherwise: Column) -> Column:
        out = None
        for prefix in sets:
            test = F.col(version).startswith(prefix)
            out = F.when(test, pick(prefix)) if out is None else out.when(test, pick(prefix))
        return out.otherwise(otherwise)

    return filled.withColumns(
        {
            "transformation_type": choose(lambda p: F.lit(TYPE_LABELS[p]), F.lit(DEFAULT_LABEL)),
            "feature_a": choose(lambda p: list(sets[p].values())[0], fallback[0]),
            "feature_b": choose(lambda p: list(sets[p].values())[1], fallback[1]),
        }
    )


def lineage_columns(df: DataFrame, processed_at: str, version: str, source: str) -> DataFrame:
    """Lineage tags; the run time is a parameter so that a rerun gives the same rows."""
    return df.withColumns(
        {
            "processed_at": F.lit(processed_at),
            "processing_version": F.lit(version),
            "transformation_type": F.lit(TYPE_LABELS.get(version[:2], DEFAULT_LABEL)),
            "source": F.lit(source),
        }
    )


def map_encode(df: DataFrame, column: str, codes: Mapping[str, int], name: str) -> DataFrame:
    """Ordinal code by a fixed map, null for other values."""
    return df.withColumn(name, lookup(codes, F.col(column)))


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values and their 0-based position in sorted order. The labels are dealt into
    ranges of equal size and stored with their range, which is the order bucket: labels with
    a common beginning are spread like any others."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = labels.repartitionByRange(shuffle_width(df.sparkSession), column).withColumn("__range", F.spark_partition_id())
    ranked = rank_in_group(materialize(dealt, "labels"), [], [F.col(column)], F.col("__range"), f"{column}_code")
    return ranked.drop(f"{column}_code_total", "__range")


def label_encode(df: DataFrame, column: str) -> DataFrame:
    return df.join(label_codes(df, column), column, "left")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def feature_columns(df: DataFrame, patterns: Sequence[str] = ("processed", "v2"), default: Sequence[str] = ()) -> list[str]:
    """Columns whose name holds one of the patterns, else the default list."""
    found = [c for c in df.columns if any(p in c for p in patterns)]
    return found or [c for c in default if c in df.columns]


# Usual names of a target column, looked up in this order.
TARGET_NAMES = ("target", "Class", "class", "label", "y")


def discover_target(df: DataFrame, names: Sequence[str] = TARGET_NAMES) -> str:
    """The first known target name present, else the last column."""
    return next((n for n in names if n in df.columns), df.columns[-1])


def split_target(df: DataFrame, target: str | None = None) -> tuple[list[str], str]:
    target = target or discover_target(df)
    return [c for c in df.columns if c != target], target


def add_row_statistics(df: DataFrame, features: str = "features") -> DataFrame:
    """Mean and std are computed once per row and reused by the higher moments."""
    base = df.withColumn("__n", F.size(features).cast("double"))
    base = base.withColumn("mean", F.aggregate(features, F.lit(0.0), lambda a, x: a + x) / F.col("__n"))
    base = base.withColumn(
        "std",
        F.sqrt(F.aggregate(features, F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / F.col("__n")),
    )

    def moment(power: int) -> Column:
        z = lambda x: (x - F.col("mean")) / F.col("std")
        return F.aggregate(features, F.lit(0.0), lambda a, x: a + F.pow(z(x), F.lit(power))) / F.col("__n")

    return base.withColumns(
        {
            "min": F.array_min(features),
            "max": F.array_max(features),
            "range": F.array_max(features) - F.array_min(features),
            "skewness": F.when(F.col("std") == 0, 0.0).otherwise(moment(3)),
            "kurtosis": F.when(F.col("std") == 0, 0.0).otherwise(moment(4) - 3),
            "num_zeros": F.size(F.filter(features, lambda x: x == 0)),
            "num_negative": F.size(F.filter(features, lambda x: x < 0)),
        }
    ).drop("__n")
