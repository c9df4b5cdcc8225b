"""Monitoring of a request log: windows, drift, latency, alerts, circuit state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.quantiles import counted_quantiles, value_counts
from millrace.functions.scalars import ratio, ts_text
from millrace.functions.selection import edge_rows
from millrace.operators.scaling import long_features

# Limits of the monitor.
RECENT_PREDICTIONS = 100
WINDOW_SIZE = 1000
BASELINE_REQUESTS = 101
MIN_CURRENT_VALUES = 50
DRIFT_THRESHOLD = 0.1
MAX_POSITIVE_RATE = 0.3
MAX_P95_MS = 1000.0
MAX_ERROR_RATE = 0.05
CIRCUIT_THRESHOLD = 3

# Items a sketch keeps per level, and the rank error that follows.
SKETCH_SIZE = 400
SKETCH_ERROR = 0.011


def request_log(requests: DataFrame, request_id: str = "request_id", ts: str = "ts", instances: Column | None = None) -> DataFrame:
    """Log record of each request: ordinal, time, number of instances and the tag put on it."""
    return requests.select(
        F.col(request_id).alias("request_id"),
        ts_text(F.col(ts)).alias("timestamp"),
        (F.lit(1) if instances is None else instances).alias("num_instances"),
        F.concat_ws("@", F.col(request_id).cast("string"), ts_text(F.col(ts))).alias("monitor_tag"),
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    return edge_rows(df, keys, order, n, latest=False)


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, n: int) -> DataFrame:
    return edge_rows(df, keys, order, n, latest=True)


def value_stats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, mean, population std, min and max of long rows."""
    return rows.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def recent_window_stats(requests: DataFrame, features: Sequence[str], keys: Sequence[str], order: str, n: int = WINDOW_SIZE) -> DataFrame:
    """Statistics of the last n values of each feature."""
    recent = latest_rows(requests.select(*keys, order, *features), keys, order, n)
    return value_stats(long_features(recent, features, keys), [*keys, "feature"])


def drift_baseline(requests: DataFrame, features: Sequence[str], keys: Sequence[str], order: str, n: int = BASELINE_REQUESTS) -> DataFrame:
    """Statistics of the first n requests, only where at least n have arrived."""
    first = first_rows(requests.select(*keys, order, *features), keys, order, n)
    stats = value_stats(long_features(first, features, keys), [*keys, "feature"])
    return stats.where(F.col("n") >= n)


def compare_windows(baseline: DataFrame, current: DataFrame, keys: Sequence[str], threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Drift of the current window against the baseline, one row per feature."""
    base = baseline.select(*keys, "feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    now = current.where(F.col("n") >= MIN_CURRENT_VALUES).select(
        *keys, "feature", F.col("mean").alias("current_mean"), F.col("n").alias("current_n")
    )
    magnitude = F.abs(F.col("current_mean") - F.col("baseline_mean")) / F.when(F.col("baseline_std") > 0, F.col("baseline_std"))
    return (
        base.join(now, [*keys, "feature"])
        .withColumn("drift_magnitude", magnitude)
        .withColumn("drifted", F.coalesce(magnitude > threshold, F.lit(False)))
    )


def drift_by_feature(requests: DataFrame, features: Sequence[str], keys: Sequence[str], order: str) -> DataFrame:
    return compare_windows(
        drift_baseline(requests, features, keys, order), recent_window_stats(requests, features, keys, order), keys
    )


def drift_summary(drift: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number and sorted names of the drifted features; the group is as long as the feature list."""
    return drift.groupBy(*keys).agg(
        F.count_if("drifted").alias("num_drifted"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("drifted"), F.col("feature")))), ",").alias("drifted_features"),
    )


def recent_rate(requests: DataFrame, keys: Sequence[str], order: str, prediction: str = "prediction", n: int = RECENT_PREDICTIONS) -> DataFrame:
    """Share of positive predictions among the last n."""
    recent = latest_rows(requests.select(*keys, order, prediction), keys, order, n)
    return recent.groupBy(*keys).agg(
        F.count("*").alias("recent_n"), F.avg((F.col(prediction) == 1).cast("double")).alias("recent_positive_rate")
    )


def _distribution(prediction: str) -> list[Column]:
    return [
        F.count("*").alias("total_predictions"),
        F.count_if(F.col(prediction) == 1).alias("positive_count"),
        F.count_if(F.col(prediction) == 0).alias("negative_count"),
        F.avg((F.col(prediction) == 1).cast("double")).alias("positive_rate"),
    ]


def prediction_distribution(requests: DataFrame, keys: Sequence[str], prediction: str = "prediction") -> DataFrame:
    return requests.groupBy(*keys).agg(*_distribution(prediction))


def _counted_mean() -> Column:
    return F.sum(F.col("__v") * F.col("__n")) / F.sum(F.when(F.col("__v").isNotNull(), F.col("__n")))


TAILS = {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def latency_percentiles(requests: DataFrame, keys: Sequence[str], latency: str = "latency_ms") -> DataFrame:
    """Mean and tails, all from the stored counts of values: the requests are read once."""
    counts = value_counts(requests, keys, latency)
    mean = counts.groupBy(*keys).agg(_counted_mean().alias("avg_latency_ms"))
    return mean.join(counted_quantiles(counts, keys, TAILS), list(keys))


def latency_sketches(requests: DataFrame, keys: Sequence[str], ts: str = "ts", latency: str = "latency_ms", span: str = "hour") -> DataFrame:
    """keys, start and a mergeable quantile sketch (KLL) of each key and span of time. Stored, it
    stands for the requests: sketches of any spans merge, and one has a few kilobytes at most."""
    start = F.date_trunc(span, F.col(ts).cast("timestamp"))
    return requests.groupBy(*keys, start.alias("start")).agg(F.kll_sketch_agg_double(F.col(latency).cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"))


def sketched_tails(sketches: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """keys, n and the quantiles named in `probs`, merged from stored sketches. Each lies within
    `SKETCH_ERROR` of its rank, as a share of n (with 99 % confidence), or is exact for few values."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("whole"))
    n = F.kll_sketch_get_n_double("whole")
    return merged.select(*keys, n.alias("n"), *[F.when(n > 0, F.kll_sketch_get_quantile_double("whole", F.lit(p))).alias(name) for name, p in probs.items()])


def service_metrics(requests: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All metrics the alerts read, one row per key: totals and tails from one stored pass over
    the requests, the recent rate from a second."""
    keys = list(keys)
    prediction = F.col("prediction")
    counts = value_counts(requests, keys, "latency_ms", errors=F.sum("error"), positive=F.count_if(prediction == 1), negative=F.count_if(prediction == 0), predicted=F.count("prediction"))
    totals = counts.groupBy(*keys).agg(
        F.sum("__n").alias("total_requests"),
        F.sum("errors").alias("error_count"),
        _counted_mean().alias("avg_latency_ms"),
        F.sum("__n").alias("total_predictions"),
        F.sum("positive").alias("positive_count"),
        F.sum("negative").alias("negative_count"),
        F.try_divide(F.sum("positive").cast("double"), F.sum("predicted")).alias("positive_rate"),
    )
    out = totals.join(counted_quantiles(counts, keys, TAILS), keys).join(recent_rate(requests, keys, order), keys)
    return out.withColumn("error_rate", ratio(F.col("error_count").cast("double"), F.col("total_requests").cast("double")))


def _alert(test: Column, kind: str, severity: str, value: Column, message: Column) -> Column:
    return F.when(
        test,
        F.struct(
            F.lit(kind).alias("type"), F.lit(severity).alias("severity"), value.cast("double").alias("value"), message.alias("message")
        ),
    )


def alerts(metrics: DataFrame, keys: Sequence[str], drift: DataFrame | None = None) -> DataFrame:
    """One row per fired alert; with a drift summary, drift is a fourth alert. The wording is
    fixed, the limits in it are those above."""
    rate, p95, errors = F.col("recent_positive_rate"), F.col("p95_latency_ms"), F.col("error_rate")
    checks = [
        _alert(
            rate > MAX_POSITIVE_RATE,
            "HIGH_FRAUD_RATE",
            "warning",
            rate,
            F.format_string(f"Recent fraud rate (%.1f%%) exceeds threshold ({MAX_POSITIVE_RATE:.1%}%)", rate * 100),
        ),
        _alert(
            p95 > MAX_P95_MS,
            "HIGH_LATENCY",
            "warning",
            p95,
            F.format_string(f"P95 latency (%.0fms) exceeds threshold ({MAX_P95_MS:.1f}ms)", p95),
        ),
        _alert(
            errors > MAX_ERROR_RATE,
            "HIGH_ERROR_RATE",
            "critical",
            errors,
            F.format_string(f"Error rate (%.1f%%) exceeds {MAX_ERROR_RATE:.0%}%", errors * 100),
        ),
    ]
    if drift is not None:
        metrics = metrics.join(drift, list(keys), "left")
        drifted = F.col("num_drifted")
        checks.append(
            _alert(drifted > 0, "DATA_DRIFT", "warning", drifted, F.format_string("%d features drifted", drifted))
        )
    return metrics.select(*keys, F.inline(F.array_compact(F.array(*checks))))


def circuit_state(requests: DataFrame, keys: Sequence[str], order: str, error: str = "error", threshold: int = CIRCUIT_THRESHOLD) -> DataFrame:
    """Failures since the last success per key, and whether the circuit is open.

    The last success comes from a partial aggregate; only failures after it are then
    counted, so no key is walked in order in one task."""
    keys = list(keys)
    rows = requests.select(*keys, F.col(order).alias("__o"), F.col(error).alias("__e"))
    stats = rows.groupBy(*keys).agg(
        F.max(F.when(F.col("__e") == 0, F.col("__o"))).alias("__ok"), F.count_if(F.col("__e") == 1).alias("total_failures")
    )
    open_failures = (
        rows.where(F.col("__e") == 1)
        .join(stats.select(*keys, "__ok"), keys)
        .where(F.col("__ok").isNull() | (F.col("__o") > F.col("__ok")))
        .groupBy(*keys)
        .agg(F.count("*").alias("__open"))
    )
    return stats.join(open_failures, keys, "left").select(
        *keys,
        "total_failures",
        F.coalesce("__open", F.lit(0)).alias("consecutive_failures"),
        circuit_label(F.coalesce("__open", F.lit(0)), threshold).alias("state"),
    )


def circuit_label(failures: Column, threshold: int = CIRCUIT_THRESHOLD) -> Column:
    return F.when(failures >= threshold, "open").otherwise("closed")


def hourly_counts(events: DataFrame, ts: str = "ts", window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Event-time windows: count and value per event type; with `slide` they overlap."""
    return events.groupBy(F.window(ts, window, slide).alias("w"), "event_type").agg(
        F.count("*").alias("events"), F.sum("value").alias("total_value")
    )
