"""Monitoring, run, cache and retention analytics."""

from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.functions.scalars import ts_text
from millrace.operators import lifecycle, monitoring, quality, runs, serving
from millrace.plans.fixtures import artifacts, cache_runs, reqs, run_nodes, run_state, sql_hash
from millrace.plans.registry import query
from millrace.session import materialize, scratch_path
from millrace.sources.files import report_json, write_parquet
from millrace.sources.tables import table

FEATURES = ["feature_0", "feature_1"]
KEYS = ["endpoint"]


def rnd(digits, *names):
    return [F.round(n, digits).alias(n) for n in names]


RECENT = """
    , recent AS (SELECT * FROM reqs QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY request_id DESC) <= 1000),
    recent_long AS (SELECT endpoint, 'feature_0' AS feature, feature_0 AS v FROM recent
                    UNION ALL SELECT endpoint, 'feature_1', feature_1 FROM recent),
    cur AS (SELECT endpoint, feature, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max
            FROM recent_long GROUP BY ALL),
    early AS (SELECT * FROM reqs QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY request_id) <= 101),
    early_long AS (SELECT endpoint, 'feature_0' AS feature, feature_0 AS v FROM early
                   UNION ALL SELECT endpoint, 'feature_1', feature_1 FROM early),
    base AS (SELECT endpoint, feature, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max
             FROM early_long GROUP BY ALL HAVING count(*) >= 101),
    drift AS (SELECT b.endpoint, b.feature, b.mean AS baseline_mean, b.std AS baseline_std, c.mean AS current_mean, c.n AS current_n,
                     abs(c.mean - b.mean) / b.std AS drift_magnitude, abs(c.mean - b.mean) / b.std > 0.1 AS drifted
              FROM base b JOIN cur c USING (endpoint, feature) WHERE c.n >= 50),
    last100 AS (SELECT * FROM reqs QUALIFY row_number() OVER (PARTITION BY endpoint ORDER BY request_id DESC) <= 100),
    rate AS (SELECT endpoint, count(*) AS recent_n, avg(prediction) AS recent_positive_rate FROM last100 GROUP BY endpoint),
    m AS (SELECT endpoint, count(*) AS total_requests, CAST(sum(error) AS BIGINT) AS error_count, avg(latency_ms) AS avg_latency_ms,
                 quantile_cont(latency_ms, 0.95) AS p95_latency_ms, quantile_cont(latency_ms, 0.99) AS p99_latency_ms,
                 count(*) AS total_predictions, count(*) FILTER (prediction = 1) AS positive_count,
                 count(*) FILTER (prediction = 0) AS negative_count, avg(prediction) AS positive_rate,
                 sum(error) / count(*) AS error_rate FROM reqs GROUP BY endpoint),
    summary AS (SELECT endpoint, count(*) FILTER (drifted) AS num_drifted,
                       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drifted), '') AS drifted_features FROM drift GROUP BY endpoint)
"""


@query(
    "request_log_batch",
    """
    SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, CAST(1 AS INTEGER) AS num_instances,
           CAST(request_id AS VARCHAR) || '@' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS monitor_tag FROM reqs
    """,
    views=("reqs",),
)
def request_log_batch(spark, sf):
    return monitoring.request_log(reqs(spark, sf))


@query(
    "recent_window_stats",
    RECENT + """ SELECT endpoint, feature, n, round(mean, 6) AS mean, round(std, 6) AS std, min, max FROM cur""",
    views=("reqs",),
)
def recent_window_stats(spark, sf):
    out = monitoring.recent_window_stats(reqs(spark, sf), FEATURES, KEYS, "request_id")
    return out.select("endpoint", "feature", "n", *rnd(6, "mean", "std"), "min", "max")


@query(
    "drift_baseline",
    RECENT + """ SELECT endpoint, feature, n, round(mean, 6) AS mean, round(std, 6) AS std, min, max FROM base""",
    views=("reqs",),
)
def drift_baseline(spark, sf):
    out = monitoring.drift_baseline(reqs(spark, sf), FEATURES, KEYS, "request_id")
    return out.select("endpoint", "feature", "n", *rnd(6, "mean", "std"), "min", "max")


@query(
    "drift_by_feature",
    RECENT + """
    SELECT endpoint, feature, round(baseline_mean, 6) AS baseline_mean, round(current_mean, 6) AS current_mean, current_n,
           round(drift_magnitude, 6) AS drift_magnitude, drifted FROM drift
    """,
    views=("reqs",),
)
def drift_by_feature(spark, sf):
    out = monitoring.drift_by_feature(reqs(spark, sf), FEATURES, KEYS, "request_id")
    return out.select(
        "endpoint", "feature", *rnd(6, "baseline_mean", "current_mean", "drift_magnitude"), "current_n", "drifted"
    )


@query(
    "recent_rate",
    RECENT + """ SELECT endpoint, recent_n, round(recent_positive_rate, 6) AS recent_positive_rate FROM rate""",
    views=("reqs",),
)
def recent_rate(spark, sf):
    out = monitoring.recent_rate(reqs(spark, sf), KEYS, "request_id")
    return out.select("endpoint", "recent_n", *rnd(6, "recent_positive_rate"))


@query(
    "latency_percentiles",
    RECENT + """
    SELECT endpoint, round(avg_latency_ms, 4) AS avg_latency_ms, round(p95_latency_ms, 4) AS p95_latency_ms,
           round(p99_latency_ms, 4) AS p99_latency_ms FROM m
    """,
    views=("reqs",),
)
def latency_percentiles(spark, sf):
    out = monitoring.latency_percentiles(reqs(spark, sf), KEYS)
    return out.select("endpoint", *rnd(4, "avg_latency_ms", "p95_latency_ms", "p99_latency_ms"))


@query(
    "service_counters",
    RECENT + """ SELECT endpoint, total_requests, error_count, round(avg_latency_ms, 4) AS avg_latency_ms FROM m""",
    views=("reqs",),
)
def service_counters(spark, sf):
    out = serving.service_counters(reqs(spark, sf), KEYS)
    return out.select("endpoint", "total_requests", "error_count", *rnd(4, "avg_latency_ms"))


@query(
    "alerts",
    RECENT + """
    SELECT endpoint, 'HIGH_FRAUD_RATE' AS type, 'warning' AS severity, round(recent_positive_rate, 4) AS value,
           printf('Recent fraud rate (%.1f%%) exceeds threshold (30.0%%)', recent_positive_rate * 100) AS message FROM rate WHERE recent_positive_rate > 0.3
    UNION ALL SELECT endpoint, 'HIGH_LATENCY', 'warning', round(p95_latency_ms, 4),
           printf('P95 latency (%.0fms) exceeds threshold (1000.0ms)', p95_latency_ms) FROM m WHERE p95_latency_ms > 1000
    UNION ALL SELECT endpoint, 'HIGH_ERROR_RATE', 'critical', round(error_rate, 4), printf('Error rate (%.1f%%) exceeds 5%%', error_rate * 100)
           FROM m WHERE error_rate > 0.05
    UNION ALL SELECT endpoint, 'DATA_DRIFT', 'warning', CAST(num_drifted AS DOUBLE), num_drifted || ' features drifted' FROM summary WHERE num_drifted > 0
    """,
    views=("reqs",),
)
def alerts(spark, sf):
    rows = reqs(spark, sf)
    drift = monitoring.drift_summary(monitoring.drift_by_feature(rows, FEATURES, KEYS, "request_id"), KEYS)
    out = monitoring.alerts(monitoring.service_metrics(rows, KEYS, "request_id"), KEYS, drift)
    return out.withColumn("value", F.round("value", 4))


@query(
    "monitor_summary",
    RECENT + """
    SELECT endpoint, total_requests, error_count, positive_count, negative_count, round(positive_rate, 6) AS positive_rate,
           round(avg_latency_ms, 4) AS avg_latency_ms, round(p95_latency_ms, 4) AS p95_latency_ms, round(recent_positive_rate, 6) AS recent_positive_rate,
           round(error_rate, 6) AS error_rate, coalesce(num_drifted, 0) AS num_drifted, coalesce(drifted_features, '') AS drifted_features,
           num_drifted IS NOT NULL AS baseline_set
    FROM m JOIN rate USING (endpoint) LEFT JOIN summary USING (endpoint)
    """,
    views=("reqs",),
)
def monitor_summary(spark, sf):
    rows = reqs(spark, sf)
    drift = monitoring.drift_summary(monitoring.drift_by_feature(rows, FEATURES, KEYS, "request_id"), KEYS)
    out = monitoring.service_metrics(rows, KEYS, "request_id").join(drift, KEYS, "left")
    return out.select(
        "endpoint", "total_requests", "error_count", "positive_count", "negative_count",
        *rnd(6, "positive_rate", "recent_positive_rate", "error_rate"), *rnd(4, "avg_latency_ms", "p95_latency_ms"),
        F.coalesce("num_drifted", F.lit(0)).alias("num_drifted"),
        F.coalesce("drifted_features", F.lit("")).alias("drifted_features"),
        F.col("num_drifted").isNotNull().alias("baseline_set"),
    )


CIRCUIT = """
    , s AS (SELECT user_id, max(event_id) FILTER (event_type <> 'error') AS ok FROM events GROUP BY user_id)
    SELECT e.user_id, count(*) FILTER (event_type = 'error') AS total_failures,
           count(*) FILTER (event_type = 'error' AND (ok IS NULL OR event_id > ok)) AS consecutive_failures,
           CASE WHEN count(*) FILTER (event_type = 'error' AND (ok IS NULL OR event_id > ok)) >= 3 THEN 'open' ELSE 'closed' END AS state
    FROM events e JOIN s USING (user_id) GROUP BY e.user_id
""".replace(", s AS", "WITH s AS", 1)


@query("circuit_state", CIRCUIT)
def circuit_state(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") == "error").cast("int").alias("error"))
    return monitoring.circuit_state(rows, ["user_id"], "event_id")


def manifests(spark, sf):
    """One manifest document per run, at most 1000 nodes each; some runs have an empty node map."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    node = F.struct(
        F.col("component").alias("displayName"),
        F.col("type").alias("type"),
        F.col("status").alias("phase"),
        F.date_format("started", iso).alias("startedAt"),
        F.date_format("finished", iso).alias("finishedAt"),
        F.col("message").alias("message"),
    )
    nodes = F.map_from_entries(F.collect_list(F.struct(F.col("node").cast("string").alias("k"), node.alias("v"))))
    grouped = run_nodes(spark, sf).groupBy("run").agg(nodes.alias("nodes"))
    kept = F.when(key_hash("run") % 20 == 0, F.map_filter("nodes", lambda k, v: F.lit(False))).otherwise(F.col("nodes"))
    return grouped.select("run", F.to_json(F.struct(F.struct(kept.alias("nodes")).alias("status"))).alias("manifest"))


@query(
    "manifest_explode",
    f"""
    , t AS (SELECT run, component, type, status, started, finished, message, CAST(node AS VARCHAR) AS node_id
            FROM run_nodes WHERE {sql_hash('run')} % 20 <> 0
            UNION ALL SELECT run, 'Pipeline', 'Pipeline', state, created, ended, error, CAST(run AS VARCHAR) FROM run_state WHERE {sql_hash('run')} % 20 = 0)
    SELECT run, component, type, status, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started, strftime(finished, '%Y-%m-%d %H:%M:%S.%f') AS finished,
           round(CAST(epoch_us(finished) - epoch_us(started) AS DOUBLE) / 1000000, 6) AS duration, message, node_id FROM t
    """,
    views=("run_nodes", "run_state"),
)
def manifest_explode(spark, sf):
    out = runs.run_timeline(manifests(spark, sf), run_state(spark, sf))
    return out.withColumns(
        {"started": ts_text(F.col("started")), "finished": ts_text(F.col("finished")), "duration": F.round("duration", 6)}
    )


def nodes(spark, sf):
    return runs.with_duration(run_nodes(spark, sf))


@query(
    "failed_nodes",
    "SELECT run, node, component, status FROM run_nodes WHERE status IN ('Failed', 'Error')",
    views=("run_nodes",),
)
def failed_nodes(spark, sf):
    return runs.failed_nodes(run_nodes(spark, sf)).select("run", "node", "component", "status")


CAUSE = """CASE WHEN message LIKE '%OOMKilled%' THEN 'Out of memory - increase memory limits'
     WHEN message LIKE '%FileNotFoundError%' THEN 'Missing input file - check artifact paths'
     WHEN message LIKE '%ModuleNotFoundError%''numpy''%' THEN 'Missing dependency: numpy'
     WHEN message LIKE '%ModuleNotFoundError%' THEN 'Missing Python dependency - check requirements'
     WHEN message LIKE '%timed out%' OR message LIKE '%deadline exceeded%' THEN 'Component timeout - increase timeout or optimize code'
     WHEN message LIKE '%Permission denied%' THEN 'Permission error - check service account and IAM roles'
     WHEN message LIKE '%connection refused%' THEN 'Network connectivity issue - check network policies'
     WHEN message LIKE '%insufficient cpu%' THEN 'Resource constraints - check cluster capacity'
     WHEN message LIKE '%ImagePullBackOff%' THEN 'Container image issue - check image name and registry access'
     ELSE 'Unknown - check component logs for details' END"""


@query("failure_cause", f"SELECT node, message, {CAUSE} AS likely_cause FROM run_nodes", views=("run_nodes",))
def failure_cause(spark, sf):
    cause = runs.failure_cause(F.lit(""), F.col("message"))
    return run_nodes(spark, sf).select("node", "message", cause.alias("likely_cause"))


@query("node_duration", "SELECT node, round(duration, 6) AS duration FROM node_times", views=("node_times",))
def node_duration(spark, sf):
    return nodes(spark, sf).select("node", *rnd(6, "duration"))


@query(
    "timeline_sorted",
    "SELECT run, row_number() OVER (PARTITION BY run ORDER BY started NULLS LAST, node) AS position, node, component, strftime(started, '%Y-%m-%d %H:%M:%S.%f') AS started FROM run_nodes",
    views=("run_nodes",),
)
def timeline_sorted(spark, sf):
    return runs.sorted_timeline(run_nodes(spark, sf)).select("run", F.col("position").cast("long").alias("position"), "node", "component", ts_text(F.col("started")).alias("started"))


STATS = """
    , st AS (SELECT run, count(*) AS total_components, count(*) FILTER (status = 'Succeeded') AS completed_components,
                    count(*) FILTER (status IN ('Failed', 'Error')) AS failed_components, 
                    CAST(sum(us) AS DOUBLE) / count(us) / 1000000 AS a, max(us) / 1000000 AS x, CAST(sum(us) AS DOUBLE) / 1000000 AS s
             FROM (SELECT *, epoch_us(finished) - epoch_us(started) AS us FROM node_times) GROUP BY run),
    h AS (SELECT run, contains(component, 'gpu') AS gpu, coalesce(epoch_us(finished) - epoch_us(started), 0) AS us FROM node_times),
    ct AS (SELECT run, CAST(sum(CASE WHEN gpu THEN 0 ELSE us * 2 END) AS DOUBLE) / 3600000000 AS cpu,
                  CAST(sum(CASE WHEN gpu THEN us ELSE 0 END) AS DOUBLE) / 3600000000 AS gpu,
                  CAST(sum(CASE WHEN gpu THEN us * 16 ELSE us * 8 END) AS DOUBLE) / 3600000000 AS mem FROM h GROUP BY run)
"""


@query(
    "run_stats",
    STATS + """
    SELECT run, total_components, completed_components, failed_components, round(coalesce(a, 0.0), 9) AS avg_component_duration,
           round(coalesce(x, 0.0), 9) AS max_component_duration, round(coalesce(s, 0.0), 9) AS total_execution_time FROM st
    """,
    views=("node_times",),
)
def run_stats(spark, sf):
    return runs.run_stats(nodes(spark, sf), digits=9)


@query(
    "run_cost",
    STATS + """
    SELECT run, round(cpu, 8) AS cpu_hours, round(gpu, 8) AS gpu_hours, round(mem, 8) AS memory_gb_hours,
           round(cpu * 0.05 + gpu * 2.5 + mem * 0.01, 8) AS estimated_cost FROM ct
    """,
    views=("node_times",),
)
def run_cost(spark, sf):
    return runs.run_cost(nodes(spark, sf), digits=8)


@query(
    "compare_runs",
    STATS + """
    SELECT run, substr(CAST(run AS VARCHAR), 1, 8) || '...' AS run_id, state AS status, total_components AS components,
           failed_components AS failures, round(round(coalesce(s, 0.0), 2) / 60, 1) AS duration_minutes,
           round(cpu * 0.05 + gpu * 2.5 + mem * 0.01, 2) AS estimated_cost
    FROM st JOIN ct USING (run) JOIN run_state USING (run)
    """,
    views=("node_times", "run_state"),
)
def compare_runs(spark, sf):
    return runs.compare_runs(nodes(spark, sf), run_state(spark, sf))


@query(
    "diagnose_runs",
    STATS + f"""
    SELECT run, component, message, round(duration, 6) AS duration_before_failure, state, total_components, failed_components, {CAUSE} AS likely_cause
    FROM node_times JOIN st USING (run) JOIN run_state USING (run) WHERE status IN ('Failed', 'Error')
    UNION ALL
    SELECT run, 'Pipeline', error, round(CAST(epoch_us(ended) - epoch_us(created) AS DOUBLE) / 1000000, 6), state, total_components, failed_components,
           'Component timeout - increase timeout or optimize code'
    FROM run_state JOIN st USING (run) WHERE state = 'Failed' AND failed_components = 0
    """,
    views=("node_times", "run_state"),
)
def diagnose_runs(spark, sf):
    out = runs.diagnose_runs(nodes(spark, sf), run_state(spark, sf))
    return out.withColumn("duration_before_failure", F.round("duration_before_failure", 6))


@query(
    "cache_stats",
    """
    , c AS (SELECT count(*) AS total_runs, count(*) FILTER (hit) AS cache_hits, count(*) FILTER (NOT hit) AS cache_misses,
                   avg(duration) FILTER (hit) AS w, avg(duration) FILTER (NOT hit) AS wo FROM cache_runs)
    SELECT total_runs, cache_hits, cache_misses, round(w, 4) AS avg_duration_with_cache, round(wo, 4) AS avg_duration_without_cache,
           round(wo / greatest(w, 1.0), 6) AS cache_speedup, round(cache_hits / total_runs, 6) AS hit_rate FROM c
    """,
    views=("cache_runs",),
)
def cache_stats(spark, sf):
    out = runs.hit_rate(runs.cache_stats(cache_runs(spark, sf), F.col("hit")))
    return out.select(
        "total_runs", "cache_hits", "cache_misses", *rnd(4, "avg_duration_with_cache", "avg_duration_without_cache"),
        *rnd(6, "cache_speedup", "hit_rate"),
    )


@query(
    "repeat_runs",
    """
    , k AS (SELECT run, created, md5('{"code_version":"c1","data_version":"' || md5('orders/' || dataset % 100)
                 || '","params":{"segment":"' || dataset % 7 || '"},"timestamp":"' || strftime(created, '%Y-%m-%d') || '"}') AS cache_key
            FROM cache_runs)
    SELECT run, cache_key, first_value(run) OVER w AS first_run, row_number() OVER w > 1 AS reusable,
           count(*) OVER (PARTITION BY cache_key) AS runs_with_key
    FROM k WINDOW w AS (PARTITION BY cache_key ORDER BY created, run)
    """,
    views=("cache_runs",),
)
def repeat_runs(spark, sf):
    dataset = F.col("dataset")
    key = lifecycle.cache_key(
        lifecycle.data_version(F.concat(F.lit("orders/"), (dataset % 100).cast("string"))),
        F.lit("c1"),
        {"segment": dataset % 7, "cache_experiment_id": F.col("run")},
        F.date_format("created", "yyyy-MM-dd"),
    )
    rows = cache_runs(spark, sf).select("run", "created", key.alias("cache_key"))
    return lifecycle.repeat_runs(rows, "cache_key", ["created", "run"]).drop("created")


@query(
    "retention_split",
    "SELECT path, type, CAST(age_days AS INTEGER) AS age_days, CASE WHEN age_days > 900 THEN 'old' ELSE 'kept' END AS retention FROM artifacts",
    views=("artifacts",),
)
def retention_split(spark, sf):
    return lifecycle.tag_retention(artifacts(spark, sf), 900).select("path", "type", "age_days", "retention")


@query(
    "retention_report",
    """
    , r AS (SELECT count(*) AS n, count(*) FILTER (age_days > 900) AS o, coalesce(sum(size_mb) FILTER (age_days > 900), 0.0) AS os,
                   coalesce(sum(size_mb) FILTER (age_days <= 900), 0.0) AS ks FROM artifacts)
    SELECT n AS total_artifacts, o AS old_artifacts, n - o AS artifacts_kept, round(os, 3) AS old_size_mb, round(ks, 3) AS space_kept_mb,
           'live' AS execution_mode, o AS artifacts_deleted, round(os, 3) AS space_freed_mb, round(os / (os + ks) * 100, 6) AS storage_reduction_percent FROM r
    """,
    views=("artifacts",),
)
def retention_report(spark, sf):
    out = lifecycle.retention_report(artifacts(spark, sf), 900, dry_run=False)
    rounded = rnd(3, "old_size_mb", "space_kept_mb", "space_freed_mb") + rnd(6, "storage_reduction_percent")
    return out.select("total_artifacts", "old_artifacts", "artifacts_kept", "execution_mode", "artifacts_deleted", *rounded)


@query(
    "retention_by_type",
    """
    SELECT type, count(*) AS count, round(sum(size_mb), 3) AS size_mb, count(*) FILTER (age_days > 900) AS old_count,
           round(coalesce(sum(size_mb) FILTER (age_days > 900), 0.0), 3) AS old_size_mb FROM artifacts GROUP BY type
    """,
    views=("artifacts",),
)
def retention_by_type(spark, sf):
    out = lifecycle.retention_by_type(artifacts(spark, sf), 900)
    return out.select("type", "count", "old_count", *rnd(3, "size_mb", "old_size_mb"))


@query(
    "report_json",
    """
    SELECT type, count(*) AS count, round(sum(size_mb), 3) AS size_mb, count(*) FILTER (age_days > 900) AS old_count,
           round(coalesce(sum(size_mb) FILTER (age_days > 900), 0.0), 3) AS old_size_mb FROM artifacts GROUP BY type
    """,
    views=("artifacts",),
)
def report_json_query(spark, sf):
    """The report as JSON documents, written and read again."""
    report = lifecycle.retention_by_type(artifacts(spark, sf), 900)
    path = write_parquet(report_json(report), scratch_path(spark, "report"))
    read = spark.read.parquet(path).select(F.from_json("report", report.schema).alias("r")).select("r.*")
    return read.select("type", "count", "old_count", *rnd(3, "size_mb", "old_size_mb"))


@query(
    "latency_sketch",
    """
    SELECT endpoint, CAST(date_trunc('day', ts) AS DATE) AS day, count(latency_ms) AS n, true AS p95_within, true AS p99_within FROM reqs GROUP BY 1, 2
    UNION ALL SELECT endpoint, NULL, count(latency_ms), true, true FROM reqs GROUP BY 1
    """,
    views=("reqs",),
)
def latency_sketch(spark, sf):
    """Tails by day and over all time from sketches stored per hour, each against its exact rank:
    within the sketch's error, or the step of one value where there are few."""
    rows = reqs(spark, sf)
    hours = materialize(monitoring.latency_sketches(rows, KEYS), "latency-sketches")
    spans = hours.withColumn("day", F.explode(F.array(F.col("start").cast("date"), F.lit(None).cast("date")))).drop("start")
    tails = monitoring.sketched_tails(spans, ["endpoint", "day"], {"p95": 0.95, "p99": 0.99})
    own = rows.select(F.col("endpoint").alias("e"), "latency_ms", F.explode(F.array(F.col("ts").cast("date"), F.lit(None).cast("date"))).alias("d"))
    met = own.join(tails, (F.col("e") == F.col("endpoint")) & F.col("d").eqNullSafe(F.col("day")))
    out = met.groupBy("endpoint", "day").agg(
        F.first("n").alias("n"),
        *[F.struct(F.count_if(F.col("latency_ms") < F.col(p)).alias("below"), F.count_if(F.col("latency_ms") <= F.col(p)).alias("upto"), F.count("latency_ms").alias("n")).alias(p) for p in ("p95", "p99")],
    )

    def within(p, share):
        slack = monitoring.SKETCH_ERROR * F.col(p)["n"] + 1
        return ((F.col(p)["below"] - slack <= share * F.col(p)["n"]) & (F.col(p)["upto"] + slack >= share * F.col(p)["n"])).alias(f"{p}_within")

    return out.select("endpoint", "day", "n", within("p95", 0.95), within("p99", 0.99))


@query(
    "distinct_sketch",
    """
    WITH c AS (SELECT 'l_orderkey' AS "column", l_returnflag AS chunk, l_orderkey AS v FROM lineitem UNION ALL SELECT 'l_partkey', l_returnflag, l_partkey FROM lineitem)
    SELECT "column", chunk, count(DISTINCT v) AS distinct_values, true AS within FROM c GROUP BY 1, 2
    UNION ALL SELECT "column", NULL, count(DISTINCT v), true FROM c GROUP BY 1
    """,
)
def distinct_sketch(spark, sf):
    """Distinct values per chunk and over all, from stored sketches: within 3 % of the exact count."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("chunk"), "l_orderkey", "l_partkey")
    held = materialize(quality.distinct_sketches(rows, ["chunk"], ["l_orderkey", "l_partkey"]), "distinct-sketches")
    found = quality.sketched_distinct(held.unionByName(held.withColumn("chunk", F.lit(None).cast("string"))), ["chunk"])
    values = rows.select(F.explode(F.array("chunk", F.lit(None))).alias("c"), F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("v")) for c in ("l_orderkey", "l_partkey")])))
    exact = values.groupBy("c", "name").agg(F.count_distinct("v").alias("distinct_values"))
    met = exact.join(found, F.col("c").eqNullSafe(F.col("chunk")) & (F.col("name") == F.col("column")))
    return met.select("column", "chunk", "distinct_values", (F.abs(F.col("estimate") - F.col("distinct_values")) <= 0.03 * F.col("distinct_values")).alias("within"))


@query(
    "registry_append",
    """
    SELECT o_custkey AS name, max(o_orderkey) AS version, 'spark-ml' AS format, 's3://models/' || o_custkey || '/' || max(o_orderkey) AS uri,
           '{"priority":"' || arg_max(o_orderpriority, o_orderkey) || '","status":"' || arg_max(o_orderstatus, o_orderkey) || '"}' AS metadata, count(*) AS versions
    FROM orders GROUP BY o_custkey
    """,
)
def registry_append(spark, sf):
    """Records with stored metadata, appended in two jobs of which the first is repeated."""
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "registry")
    uri = F.concat_ws("/", F.lit("s3://models"), "o_custkey", "o_orderkey")
    records = lifecycle.registry_record(orders, F.col("o_custkey"), F.col("o_orderkey"), uri, priority=F.col("o_orderpriority"), status=F.col("o_orderstatus"))
    for half in (0, 0, 1):
        lifecycle.append_records(records.where(F.col("version") % 2 == half), path)
    return lifecycle.registry_latest(spark.read.parquet(path))


@query(
    "registry_latest",
    """
    SELECT o_custkey AS name, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS format,
           's3://models/' || o_custkey || '/' || max(o_orderkey) AS uri, count(*) AS versions FROM orders GROUP BY o_custkey
    """,
)
def registry_latest(spark, sf):
    uri = F.concat_ws("/", F.lit("s3://models"), "o_custkey", "o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("name"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("format"), uri.alias("uri")
    )
    return lifecycle.registry_latest(rows)
