"""Pipeline-run analytics: timelines, failures, costs, caches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import any_of, ratio

NODE_SCHEMA = (
    "struct<status: struct<nodes: map<string, struct<displayName: string, type: string, phase: string,"
    " startedAt: string, finishedAt: string, message: string>>>>"
)
# Run states, and those that mean failure.
RUN_STATES = ["Pending", "Running", "Succeeded", "Failed", "Error", "Skipped", "Terminated", "Omitted"]
FAILED_STATES = ["Failed", "Error"]

# Keyword rules for the likely cause, first match wins.
CAUSES = [
    (("oomkilled", "memory limit", "out of memory"), "Out of memory - increase memory limits"),
    (("filenotfounderror", "no such file", "file not found"), "Missing input file - check artifact paths"),
    (("modulenotfounderror",), None),
    (("timeout", "timed out", "deadline exceeded"), "Component timeout - increase timeout or optimize code"),
    (("permission denied", "accessdenied", "unauthorized"), "Permission error - check service account and IAM roles"),
    (("connection refused", "network unreachable", "dns resolution"), "Network connectivity issue - check network policies"),
    (("insufficient cpu", "insufficient memory", "resource quotas"), "Resource constraints - check cluster capacity"),
    (("imagepullbackoff", "image not found", "pull access denied"), "Container image issue - check image name and registry access"),
]
MODULE_PATTERN = "modulenotfounderror.*'([^']+)'"
MODULE_DEFAULT = "Missing Python dependency - check requirements"
UNKNOWN_CAUSE = "Unknown - check component logs for details"

# Hourly prices and the resources assumed per component.
PRICES = {"cpu": 0.05, "gpu": 2.50, "memory_gb": 0.01}
GPU_TERMS = ("gpu", "cuda", "nvidia")
GPU_MEMORY_GB, CPU_COUNT, CPU_MEMORY_GB = 16, 2, 8


def seconds_between(started: Column, finished: Column) -> Column:
    """Seconds between two timestamps, null when either is missing."""
    return (F.unix_micros(finished) - F.unix_micros(started)).cast("double") / 1000000


def _micros(seconds: Column) -> Column:
    """Whole microseconds: sums of these do not depend on the order of the rows."""
    return F.round(seconds * 1000000).cast("long")


def explode_manifests(manifests: DataFrame, run: str = "run", manifest: str = "manifest") -> DataFrame:
    """Timeline rows from manifest JSON, times that do not parse become null."""
    parsed = manifests.select(run, F.explode(F.from_json(manifest, NODE_SCHEMA)["status"]["nodes"]).alias("node_id", "n"))
    return parsed.select(
        run,
        F.coalesce("n.displayName", "node_id").alias("component"),
        F.col("n.type").alias("type"),
        F.col("n.phase").alias("status"),
        F.try_to_timestamp("n.startedAt").alias("started"),
        F.try_to_timestamp("n.finishedAt").alias("finished"),
        F.coalesce("n.message", F.lit("")).alias("message"),
        "node_id",
    )


def run_timeline(manifests: DataFrame, runs: DataFrame, run: str = "run", manifest: str = "manifest") -> DataFrame:
    """Node rows of every run; a run whose manifest has no nodes gets one row from the run record."""
    nodes = explode_manifests(manifests, run, manifest)
    bare = runs.join(nodes.select(run).distinct(), run, "left_anti").select(
        run,
        F.lit("Pipeline").alias("component"),
        F.lit("Pipeline").alias("type"),
        F.col("state").alias("status"),
        F.col("created").alias("started"),
        F.col("ended").alias("finished"),
        F.coalesce("error", F.lit("")).alias("message"),
        F.col(run).cast("string").alias("node_id"),
    )
    return nodes.unionByName(bare).withColumn("duration", seconds_between(F.col("started"), F.col("finished")))


def with_duration(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("duration", seconds_between(F.col("started"), F.col("finished")))


def sorted_timeline(nodes: DataFrame, run: str = "run", node: str = "node") -> DataFrame:
    """The nodes of each run in order of their start, with their 1-based position; a run is one
    manifest, so it is bounded."""
    order = Window.partitionBy(run).orderBy(F.col("started").asc_nulls_last(), node)
    return nodes.withColumn("position", F.row_number().over(order))


def failed_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("status").isin(*FAILED_STATES))


def valid_status(status: Column) -> Column:
    return status.isin(*RUN_STATES)


def failure_cause(logs: Column, message: Column) -> Column:
    """Likely cause by the first keyword rule that matches the logs and the message."""
    text = F.lower(F.concat(F.coalesce(logs, F.lit("")), F.lit(" "), F.coalesce(message, F.lit(""))))
    module = F.regexp_extract(text, MODULE_PATTERN, 1)
    module_cause = F.when(module != "", F.concat(F.lit("Missing dependency: "), module)).otherwise(MODULE_DEFAULT)
    rules = [F.when(any_of(text, words), module_cause if cause is None else F.lit(cause)) for words, cause in CAUSES]
    return F.coalesce(*rules, F.lit(UNKNOWN_CAUSE))


def _stat_columns(digits: int) -> list[Column]:
    micro = _micros(F.col("duration"))

    def rounded(value: Column) -> Column:
        return F.round(F.coalesce(value / 1000000, F.lit(0.0)), digits)

    return [
        F.count("*").alias("total_components"),
        F.count_if(F.col("status") == "Succeeded").alias("completed_components"),
        F.count_if(F.col("status").isin(*FAILED_STATES)).alias("failed_components"),
        rounded(F.try_divide(F.sum(micro), F.count(micro))).alias("avg_component_duration"),
        rounded(F.max(micro)).alias("max_component_duration"),
        rounded(F.sum(micro)).alias("total_execution_time"),
    ]


def _hour_columns() -> list[Column]:
    micro = F.coalesce(_micros(F.col("duration")), F.lit(0))
    gpu = any_of(F.lower("component"), GPU_TERMS)

    def hours(on_gpu: int, on_cpu: int) -> Column:
        return F.sum(F.when(gpu, micro * on_gpu).otherwise(micro * on_cpu)) / 3600000000.0

    return [
        hours(0, CPU_COUNT).alias("cpu_hours"),
        hours(1, 0).alias("gpu_hours"),
        hours(GPU_MEMORY_GB, CPU_MEMORY_GB).alias("memory_gb_hours"),
    ]


def _cost(prices: Mapping[str, float]) -> Column:
    return sum((F.col(f"{kind}_hours") * price for kind, price in prices.items()), F.lit(0.0))


def run_stats(nodes: DataFrame, run: str = "run", digits: int = 2) -> DataFrame:
    """Component counts and durations per run; 0 where no duration is known."""
    return nodes.groupBy(run).agg(*_stat_columns(digits))


def run_cost(nodes: DataFrame, run: str = "run", prices: Mapping[str, float] = PRICES, digits: int = 2) -> DataFrame:
    """Resource hours and estimated cost per run."""
    hours = nodes.groupBy(run).agg(*_hour_columns()).withColumn("estimated_cost", _cost(prices))
    return hours.select(
        run, *[F.round(c, digits).alias(c) for c in ("cpu_hours", "gpu_hours", "memory_gb_hours", "estimated_cost")]
    )


def compare_runs(nodes: DataFrame, runs: DataFrame, run: str = "run", prices: Mapping[str, float] = PRICES) -> DataFrame:
    """Short id, state, components, failures, minutes and cost of every run, from one
    aggregate over the nodes."""
    summary = nodes.groupBy(run).agg(*_stat_columns(2), *_hour_columns())
    return summary.join(runs.select(run, "state"), run).select(
        run,
        F.concat(F.substring(F.col(run).cast("string"), 1, 8), F.lit("...")).alias("run_id"),
        F.col("state").alias("status"),
        F.col("total_components").alias("components"),
        F.col("failed_components").alias("failures"),
        F.round(F.col("total_execution_time") / 60, 1).alias("duration_minutes"),
        F.round(_cost(prices), 2).alias("estimated_cost"),
    )


def diagnose_runs(nodes: DataFrame, runs: DataFrame, run: str = "run") -> DataFrame:
    """One row per failed component with its likely cause and the run's counts; a failed run
    without a failed component gets one row from its own error text."""
    counts = nodes.groupBy(run).agg(
        F.count("*").alias("total_components"), F.count_if(F.col("status").isin(*FAILED_STATES)).alias("failed_components")
    )
    record = runs.join(counts, run, "left").select(
        run,
        "state",
        "error",
        "created",
        "ended",
        F.coalesce("total_components", F.lit(0)).alias("total_components"),
        F.coalesce("failed_components", F.lit(0)).alias("failed_components"),
    )
    node_level = failed_nodes(nodes).select(run, "component", "message", F.col("duration").alias("duration_before_failure"))
    node_level = node_level.join(record.drop("error", "created", "ended"), run)
    run_level = record.where((F.col("failed_components") == 0) & F.col("state").isin(*FAILED_STATES)).select(
        run,
        F.lit("Pipeline").alias("component"),
        F.col("error").alias("message"),
        seconds_between(F.col("created"), F.col("ended")).alias("duration_before_failure"),
        "state",
        "total_components",
        "failed_components",
    )
    return node_level.unionByName(run_level).withColumn("likely_cause", failure_cause(F.lit(""), F.col("message")))


def cache_stats(runs: DataFrame, hit: Column, duration: str = "duration") -> DataFrame:
    """Hits, misses, mean duration of each and the speed-up of a hit."""

    def mean_where(test: Column) -> Column:
        return F.coalesce(F.avg(F.when(test, F.col(duration))), F.lit(0.0))

    return runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if(hit).alias("cache_hits"),
        F.count_if(~hit).alias("cache_misses"),
        mean_where(hit).alias("avg_duration_with_cache"),
        mean_where(~hit).alias("avg_duration_without_cache"),
    ).withColumn(
        "cache_speedup",
        F.when(
            F.col("avg_duration_without_cache") > 0,
            F.col("avg_duration_without_cache") / F.greatest("avg_duration_with_cache", F.lit(1.0)),
        ),
    )


def name_suggests_cache(name: Column) -> Column:
    """Hit predicate for runs that only carry a name."""
    return F.lower(name).contains("cache")


def hit_rate(stats: DataFrame) -> DataFrame:
    return stats.withColumn("hit_rate", ratio(F.col("cache_hits").cast("double"), F.col("total_runs").cast("double")))
