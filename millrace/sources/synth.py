"""Synthetic tables: every cell is a function of the row key and a seed, so any task can
recompute any row and the table does not depend on its partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import seeded_normal, seeded_uniform
from millrace.operators.splits import exact_sample


def keys(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    return spark.range(0, rows, 1, partitions)


def exponential(key: str, salt: str, scale: float) -> Column:
    return F.lit(-scale) * F.log(seeded_uniform(key, salt))


def feature_table(ids: DataFrame, seed: int = 42, null_share: float = 0.05, wide: bool = False, key: str = "id") -> DataFrame:
    """id, normal, exponential, category, Bernoulli target, minute timestamps; exactly
    `null_share` of feature_1 is null. `wide` adds a uniform and a gamma column."""
    s = str(seed)
    out = ids.select(
        key,
        seeded_normal(key, f"{s}/1").alias("feature_1"),
        exponential(key, f"{s}/2", 2.0).alias("feature_2"),
        F.get(F.array(F.lit("A"), F.lit("B"), F.lit("C")), F.floor(seeded_uniform(key, f"{s}/3") * 3).cast("int")).alias("feature_3"),
        (seeded_uniform(key, f"{s}/t") < 0.3).cast("int").alias("target"),
        F.timestamp_seconds(F.lit(1704067200) + F.col(key) * 60).alias("timestamp"),
    )
    if wide:
        out = out.withColumns(
            {
                "feature_4": seeded_uniform(key, f"{s}/4") * 2 - 1,
                "feature_5": exponential(key, f"{s}/5a", 2.0) + exponential(key, f"{s}/5b", 2.0),
            }
        )
    flagged = exact_sample(out, [key], null_share, "__null", salt=f"{s}/null")
    return flagged.withColumn("feature_1", F.when(~F.col("__null"), F.col("feature_1"))).drop("__null")


def imbalanced_table(ids: DataFrame, seed: int = 42, positive_share: float = 0.03, key: str = "id") -> DataFrame:
    """Amount, Time, V1..V28 and Class, about `positive_share` positive; half of the columns
    are shifted for the positive class."""
    s = str(seed)
    out = ids.select(key, (seeded_uniform(key, f"{s}/class") < positive_share).cast("int").alias("Class"))
    names = ["Amount", "Time", *[f"V{i}" for i in range(1, 29)]]
    return out.withColumns(
        {
            n: seeded_normal(key, f"{s}/{n}") + (F.col("Class") * F.lit(1.5) if i % 2 == 0 else F.lit(0.0))
            for i, n in enumerate(names)
        }
    )


def rule_label_table(ids: DataFrame, seed: int = 42, flip_share: float = 0.1, key: str = "id") -> DataFrame:
    """Eight normals, a non-linear rule label, and exactly `flip_share` of the labels flipped."""
    s = str(seed)
    out = ids.select(key, *[seeded_normal(key, f"{s}/x{i}").alias(f"feature_{i}") for i in range(8)])
    x = [F.col(f"feature_{i}") for i in range(8)]
    rule = ((x[0] > 0) & (x[1] > 0)) | (x[2] * x[2] + x[3] * x[3] > 1) | (x[4] > 1.5) | (x[5] * x[6] > 0.5)
    flagged = exact_sample(out.withColumn("clean_label", rule.cast("int")), [key], flip_share, "__flip", salt=f"{s}/flip")
    return flagged.withColumn(
        "label", F.when(F.col("__flip"), 1 - F.col("clean_label")).otherwise(F.col("clean_label"))
    ).drop("__flip")


def uniform_batch(ids: DataFrame, seed: int = 42, features: int = 30, low: float = 2.0, high: float = 5.0, key: str = "id") -> DataFrame:
    """Random scoring instances: `features` uniforms per row."""
    cells = [seeded_uniform(key, f"{seed}/u{i}") * (high - low) + low for i in range(features)]
    return ids.select(key, F.array(*cells).alias("features"))
