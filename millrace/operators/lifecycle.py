"""Artifact retention, cache keys and the model registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import ratio

# Parameters left out of the cache key, and the length of a key that is shown.
IGNORED_PARAMS = ("cache_experiment_id",)
SHOWN_KEY_LENGTH = 8


def tag_retention(artifacts: DataFrame, days: int) -> DataFrame:
    """'old' when strictly older than the policy, else 'kept'."""
    return artifacts.withColumn("retention", F.when(F.col("age_days") > days, "old").otherwise("kept"))


def retention_report(artifacts: DataFrame, days: int, dry_run: bool = True) -> DataFrame:
    """Counts and sizes of old and kept artifacts; a dry run frees nothing."""
    old = F.col("age_days") > days
    size = F.col("size_mb")
    sums = artifacts.agg(
        F.count("*").alias("total_artifacts"),
        F.count_if(old).alias("old_artifacts"),
        F.count_if(~old).alias("artifacts_kept"),
        F.coalesce(F.sum(F.when(old, size)), F.lit(0.0)).alias("old_size_mb"),
        F.coalesce(F.sum(F.when(~old, size)), F.lit(0.0)).alias("space_kept_mb"),
    )
    freed = F.lit(0.0) if dry_run else F.col("old_size_mb")
    return sums.select(
        "*",
        F.lit("dry_run" if dry_run else "live").alias("execution_mode"),
        (F.lit(0).cast("long") if dry_run else F.col("old_artifacts")).alias("artifacts_deleted"),
        freed.alias("space_freed_mb"),
        (ratio(freed, F.col("old_size_mb") + F.col("space_kept_mb")) * 100).alias("storage_reduction_percent"),
    )


def retention_by_type(artifacts: DataFrame, days: int) -> DataFrame:
    old = F.col("age_days") > days
    return artifacts.groupBy("type").agg(
        F.count("*").alias("count"),
        F.sum("size_mb").alias("size_mb"),
        F.count_if(old).alias("old_count"),
        F.coalesce(F.sum(F.when(old, F.col("size_mb"))), F.lit(0.0)).alias("old_size_mb"),
    )


def data_version(address: Column) -> Column:
    return F.md5(address)


def cache_key(data: Column, code: Column, params: dict[str, Column], day: Column) -> Column:
    """md5 over the sorted JSON of everything that affects a result. The day is a
    parameter; parameters that do not affect the result are left out."""
    kept = {k: params[k] for k in sorted(params) if k not in IGNORED_PARAMS}
    document = F.to_json(
        F.struct(
            code.alias("code_version"),
            data.alias("data_version"),
            F.struct(*[v.cast("string").alias(k) for k, v in kept.items()]).alias("params"),
            day.alias("timestamp"),
        )
    )
    return F.md5(document)


def shown_key(key: Column) -> Column:
    """The short form for reports; runs are grouped by the whole key."""
    return F.substring(key, 1, SHOWN_KEY_LENGTH)


def repeat_runs(runs: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Mark runs whose key an earlier run already had, and name that first run. The first
    run per key is a partial aggregate joined back, so a hot key is never sorted."""
    first = runs.groupBy(key).agg(F.min(F.struct(*order)).alias("__first"), F.count("*").alias("runs_with_key"))
    return (
        runs.join(first, key)
        .withColumn("first_run", F.col("__first")[order[-1]])
        .withColumn("reusable", F.struct(*order) != F.col("__first"))
        .drop("__first")
    )


def registry_latest(registry: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """The newest record of every model."""
    record = F.struct(*[c for c in registry.columns if c != name])
    latest = registry.groupBy(name).agg(F.max_by(record, F.col(version)).alias("r"), F.count("*").alias("versions"))
    return latest.select(name, "r.*", "versions")


def registry_record(runs: DataFrame, name: Column, version: Column, uri: Column, **metadata: Column) -> DataFrame:
    """Registry rows ready to append: name, version, format, address and metadata JSON."""
    return runs.select(
        name.alias("name"),
        version.alias("version"),
        F.lit("spark-ml").alias("format"),
        uri.alias("uri"),
        F.to_json(F.struct(*[v.alias(k) for k, v in sorted(metadata.items())])).alias("metadata"),
    )


def append_records(records: DataFrame, path: str) -> None:
    """Append the records whose name and version the registry does not have yet: a repeated job
    appends nothing, and records are never rewritten."""
    spark = records.sparkSession
    new = records.dropDuplicates(["name", "version"])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.parquet(path).select(F.col("name").alias("__name"), F.col("version").alias("__version"))
        new = new.join(known, F.col("name").eqNullSafe(F.col("__name")) & F.col("version").eqNullSafe(F.col("__version")), "left_anti")
    new.write.mode("append").parquet(path)
