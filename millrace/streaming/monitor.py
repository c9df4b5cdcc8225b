"""The monitor as streams: request log, windows, drift, distribution, alerts, circuits.

Every stream takes an optional `folder` in the shared file system. A later call with the same
folder goes on where the earlier one ended, also without new data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import ratio
from millrace.operators import cleaning, monitoring
from millrace.operators.scaling import long_features
from millrace.streaming.jobs import append_to_parquet, drop_epoch, epoch_path, for_each_batch, last_epoch, work_folders
from millrace.streaming.keyed import edge_state, open_failures
from millrace.streaming.versions import VersionedTable

LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def log_requests(requests: DataFrame, folder: str | None = None) -> DataFrame:
    """Append-only request log; the ordinal is the request id, not a counter."""
    path, checkpoint = work_folders(requests.sparkSession, "request-log", folder)
    append_to_parquet(monitoring.request_log(requests), path, checkpoint)
    return requests.sparkSession.read.parquet(path)


def window_state(requests: DataFrame, features: Sequence[str], keys: Sequence[str], order: str, folder: str | None = None) -> DataFrame:
    """The first rows (baseline) and the latest rows (window) of every key, in per-key state: a
    batch writes the lists of the keys it holds. Files may come in any order."""
    _, checkpoint = work_folders(requests.sparkSession, "window-state", folder)
    return edge_state(requests, keys, order, features, monitoring.BASELINE_REQUESTS, monitoring.WINDOW_SIZE, checkpoint)


def state_stats(state: DataFrame, kind: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    rows = state.where(F.col("kind") == kind)
    return monitoring.value_stats(long_features(rows, features, keys), [*keys, "feature"])


def drift_from_state(state: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Baseline and current window compared; no row for a key without a full baseline."""
    baseline = state_stats(state, "first", features, keys).where(F.col("n") >= monitoring.BASELINE_REQUESTS)
    return monitoring.compare_windows(baseline, state_stats(state, "recent", features, keys), keys)


def prediction_totals(requests: DataFrame, keys: Sequence[str], folder: str | None = None) -> DataFrame:
    """Cumulative class counts kept in Spark's own aggregation state; every batch writes the
    complete small result, the last one is returned."""
    spark = requests.sparkSession
    path, checkpoint = work_folders(spark, "prediction-totals", folder)

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(epoch_path(path, epoch))
        if epoch > 0:
            drop_epoch(batch.sparkSession, path, epoch - 1)

    for_each_batch(monitoring.prediction_distribution(requests, keys), checkpoint, handle, "complete")
    last = last_epoch(spark, path)
    if last is None:
        raise ValueError("the stream had no data")
    return spark.read.parquet(epoch_path(path, last))


def window_alerts(requests: DataFrame, keys: Sequence[str], window: str = "1 day", delay: str = "10 minutes", folder: str | None = None) -> DataFrame:
    """Alerts of every closed event-time window: positive rate, p95 latency from a mergeable
    sketch, error rate."""
    spark = requests.sparkSession
    path, checkpoint = work_folders(spark, "window-alerts", folder)
    metrics = (
        requests.withColumn("event_time", F.col("ts").cast("timestamp"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window).alias("w"), *keys)
        .agg(
            F.avg((F.col("prediction") == 1).cast("double")).alias("recent_positive_rate"),
            F.percentile_approx("latency_ms", 0.95, 10000).alias("p95_latency_ms"),
            ratio(F.sum("error").cast("double"), F.count("*").cast("double")).alias("error_rate"),
        )
        .withColumn("window_start", F.col("w.start"))
    )
    append_to_parquet(monitoring.alerts(metrics, [*keys, "window_start"]), path, checkpoint)
    return spark.read.parquet(path)


def hourly_events(events: DataFrame, delay: str = "10 minutes", folder: str | None = None, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Closed windows per event type, tumbling or (with `slide`) sliding; events later than the
    delay are left out (`event_accounts` counts them)."""
    spark = events.sparkSession
    path, checkpoint = work_folders(spark, "hourly-events", folder)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    append_to_parquet(monitoring.hourly_counts(timed, window=window, slide=slide), path, checkpoint)
    return spark.read.parquet(path)


def user_sessions(events: DataFrame, keys: Sequence[str], gap: str, delay: str = "10 minutes", folder: str | None = None) -> DataFrame:
    """Closed sessions of every key: events less than `gap` apart, with their number and value. A
    session is written when the watermark passes its end. Sessions are merged in each task before
    the shuffle, so a hot key sends sessions, not events."""
    spark = events.sparkSession
    path, checkpoint = work_folders(spark, "user-sessions", folder)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    sessions = timed.groupBy(F.session_window("ts", gap).alias("w"), *keys).agg(F.count("*").alias("events"), F.sum("value").alias("total_value"))
    before = spark.conf.get(LOCAL_SESSIONS, "false")
    spark.conf.set(LOCAL_SESSIONS, "true")
    try:
        append_to_parquet(sessions, path, checkpoint)
    finally:
        spark.conf.set(LOCAL_SESSIONS, before)
    return spark.read.parquet(path)


def distinct_events(events: DataFrame, key: Sequence[str], delay: str, folder: str | None = None) -> DataFrame:
    """Every event once, by its key: copies that come within the delay are dropped, and the state
    keeps keys for that long only. Events later than the delay are left out."""
    spark = events.sparkSession
    path, checkpoint = work_folders(spark, "distinct-events", folder)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    append_to_parquet(timed.dropDuplicatesWithinWatermark(list(key)), path, checkpoint)
    return spark.read.parquet(path)


def event_accounts(events: DataFrame, closed: DataFrame, folder: str, counted: str = "events", windows: int = 1) -> DataFrame:
    """What became of the events a window or session stream has read: events, those in closed
    windows, in open ones (in the stream's state), and late ones, which were left out. An event
    counts once in each of the `windows` that hold it; events without a time are late."""
    spark = closed.sparkSession
    state = spark.read.format("statestore").load(f"{folder.rstrip('/')}/checkpoint")
    number = F.col(f"value.{counted}") if counted in state.schema["value"].dataType.fieldNames() else F.col("value.count")
    sums = [
        events.agg((F.count("*") * windows).alias("n")).select(F.col("n").alias("events"), F.lit(0).alias("closed"), F.lit(0).alias("open")),
        closed.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("n")).select(F.lit(0), "n", F.lit(0)),
        state.agg(F.coalesce(F.sum(number), F.lit(0)).alias("n")).select(F.lit(0), F.lit(0), "n"),
    ]
    total = sums[0].union(sums[1]).union(sums[2]).agg(*(F.sum(c).cast("long").alias(c) for c in ("events", "closed", "open")))
    return total.withColumn("late", F.col("events") - F.col("closed") - F.col("open"))


def circuit_states(requests: DataFrame, keys: Sequence[str], order: str, folder: str | None = None) -> DataFrame:
    """Failures, those since the last success, and the circuit of every key, in per-key state.
    Files may come in any order: a success that arrives late only ends the failures before it."""
    _, checkpoint = work_folders(requests.sparkSession, "circuit-state", folder)
    counts = open_failures(requests, keys, order, "error", checkpoint)
    return counts.withColumn("state", monitoring.circuit_label(F.col("consecutive_failures")))


def process_checkpointed(rows: DataFrame, batch_id: str = "batch_id", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Resumable batch processing: every micro-batch writes its processed rows into a versioned
    table, the stream checkpoint remembers what is done. Where a batch id goes on in a later
    micro-batch, its rows so far are processed again with the new ones, and the newest version
    counts. Returns the processed rows, and the rows and newest version (epoch) of each batch id."""
    spark = rows.sparkSession
    path, checkpoint = work_folders(spark, "checkpointed", folder)

    def handle(batch: DataFrame, epoch: int) -> None:
        VersionedTable(batch.sparkSession, path, batch_id).merge(batch, epoch, lambda whole: cleaning.process_batches(whole, batch_id))

    for_each_batch(rows, checkpoint, handle)
    done = VersionedTable(spark, path, batch_id).read()
    return done.drop("epoch"), done.groupBy(batch_id, "epoch").agg(F.count("*").alias("rows_in_batch"))
