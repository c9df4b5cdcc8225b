"""Streams over the events table, checked against their batch form."""

from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.functions.scalars import micros
from millrace.plans.fixtures import feat_from, reqs_from
from millrace.plans.operations import CIRCUIT, FEATURES, KEYS, RECENT, rnd
from millrace.plans.registry import query
from millrace.streaming import monitor
from millrace.streaming.jobs import stream_table


def request_stream(spark, sf):
    return reqs_from(stream_table(spark, sf, "events"))


@query(
    "request_log",
    """
    SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, CAST(1 AS INTEGER) AS num_instances,
           CAST(request_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS monitor_tag FROM reqs
    """,
    views=("reqs",),
)
def request_log(spark, sf):
    return monitor.log_requests(request_stream(spark, sf))


@query(
    "recent_window_stream",
    RECENT + """ SELECT endpoint, feature, n, round(mean, 6) AS mean, round(std, 6) AS std, min, max FROM cur""",
    views=("reqs",),
)
def recent_window_stream(spark, sf):
    state = monitor.window_state(request_stream(spark, sf), FEATURES, KEYS, "request_id")
    out = monitor.state_stats(state, "recent", FEATURES, KEYS)
    return out.select("endpoint", "feature", "n", *rnd(6, "mean", "std"), "min", "max")


@query(
    "drift_stream",
    RECENT + """
    SELECT endpoint, feature, round(baseline_mean, 6) AS baseline_mean, round(current_mean, 6) AS current_mean, current_n,
           round(drift_magnitude, 6) AS drift_magnitude, drifted FROM drift
    """,
    views=("reqs",),
)
def drift_stream(spark, sf):
    state = monitor.window_state(request_stream(spark, sf), FEATURES, KEYS, "request_id")
    out = monitor.drift_from_state(state, FEATURES, KEYS)
    return out.select(
        "endpoint", "feature", *rnd(6, "baseline_mean", "current_mean", "drift_magnitude"), "current_n", "drifted"
    )


@query(
    "prediction_distribution",
    RECENT + """ SELECT endpoint, total_predictions, positive_count, negative_count, round(positive_rate, 6) AS positive_rate FROM m""",
    views=("reqs",),
)
def prediction_distribution(spark, sf):
    out = monitor.prediction_totals(request_stream(spark, sf), KEYS)
    return out.select("endpoint", "total_predictions", "positive_count", "negative_count", *rnd(6, "positive_rate"))


@query(
    "alerts_stream",
    """
    , w AS (SELECT date_trunc('day', ts) AS d, endpoint, avg(prediction) AS rate, quantile_disc(latency_ms, 0.95) AS p95, avg(error) AS err
            FROM reqs WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM reqs) - INTERVAL 10 MINUTE GROUP BY 1, 2)
    SELECT epoch_us(d) AS window_start, endpoint, 'HIGH_FRAUD_RATE' AS type, 'warning' AS severity, round(rate, 6) AS value FROM w WHERE rate > 0.3
    UNION ALL SELECT epoch_us(d), endpoint, 'HIGH_LATENCY', 'warning', round(p95, 6) FROM w WHERE p95 > 1000
    UNION ALL SELECT epoch_us(d), endpoint, 'HIGH_ERROR_RATE', 'critical', round(err, 6) FROM w WHERE err > 0.05
    """,
    views=("reqs",),
)
def alerts_stream(spark, sf):
    out = monitor.window_alerts(request_stream(spark, sf), KEYS)
    return out.select(micros(F.col("window_start")).alias("window_start"), "endpoint", "type", "severity", *rnd(6, "value"))


@query(
    "events_hourly",
    """
    SELECT epoch_us(date_trunc('hour', ts)) AS hour, event_type, count(*) AS events, round(sum(value), 4) AS total_value FROM events
    GROUP BY date_trunc('hour', ts), event_type
    HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def events_hourly(spark, sf):
    out = monitor.hourly_events(stream_table(spark, sf, "events"))
    return out.select(micros(F.col("w.start")).alias("hour"), "event_type", "events", *rnd(4, "total_value"))


@query(
    "events_sliding",
    """
    WITH h AS (SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS hour, event_type, value FROM events, (SELECT unnest([0, 1, 2]) AS k))
    SELECT epoch_us(hour) AS hour, event_type, count(*) AS events, round(sum(value), 4) AS total_value FROM h GROUP BY hour, event_type
    HAVING hour + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def events_sliding(spark, sf):
    out = monitor.hourly_events(stream_table(spark, sf, "events"), window="3 hours", slide="1 hour")
    return out.select(micros(F.col("w.start")).alias("hour"), "event_type", "events", *rnd(4, "total_value"))


@query(
    "user_sessions_stream",
    """
    WITH g AS (SELECT user_id, event_id, ts, value, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 4 HOUR THEN 0 ELSE 1 END AS first FROM events),
    n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts) + INTERVAL 4 HOUR) AS session_end, count(*) AS events, round(sum(value), 4) AS total_value
    FROM n GROUP BY user_id, k HAVING max(ts) + INTERVAL 4 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def user_sessions_stream(spark, sf):
    out = monitor.user_sessions(stream_table(spark, sf, "events"), ["user_id"], "4 hours")
    return out.select("user_id", micros(F.col("w.start")).alias("session_start"), micros(F.col("w.end")).alias("session_end"), "events", *rnd(4, "total_value"))


@query("distinct_stream", "SELECT DISTINCT event_id, user_id, event_type, value, epoch_us(ts) AS at FROM events")
def distinct_stream(spark, sf):
    """Every third event is delivered twice and every tenth three times."""
    h = key_hash("event_id")
    copies = F.when(h % 10 == 0, 3).when(h % 3 == 0, 2).otherwise(1)
    delivered = stream_table(spark, sf, "events").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    out = monitor.distinct_events(delivered.drop("copy"), ["event_id"], "10 minutes")
    return out.select("event_id", "user_id", "event_type", "value", micros(F.col("ts")).alias("at"))


@query("circuit_stream", CIRCUIT)
def circuit_stream(spark, sf):
    rows = stream_table(spark, sf, "events").select(
        "user_id", "event_id", (F.col("event_type") == "error").cast("int").alias("error")
    )
    return monitor.circuit_states(rows, ["user_id"], "event_id")


@query(
    "checkpointed_process",
    """
    SELECT id, batch_id, round(coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)), 6) AS f1_processed,
           round(sqrt(CASE WHEN f2 > 0 THEN f2 ELSE 0.001 END), 6) AS f2_sqrt,
           round(coalesce(f1, avg(f1) OVER (PARTITION BY batch_id)) * sqrt(CASE WHEN f2 > 0 THEN f2 ELSE 0.001 END), 6) AS interaction
    FROM feat
    """,
    views=("feat",),
)
def checkpointed_process(spark, sf):
    rows, _ = monitor.process_checkpointed(feat_from(stream_table(spark, sf, "events")).drop("ts"))
    return rows.select("id", "batch_id", *rnd(6, "f1_processed", "f2_sqrt", "interaction"))
