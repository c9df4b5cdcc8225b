"""Input views over the given tables: a Spark form and a SQL form of each.

The tables carry no nulls, runs or trials; the views derive them by fixed rules so
every operator has an input that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.functions.prefix import id_order_bucket, rank_in_group
from millrace.functions.scalars import lookup, single_row
from millrace.sources.tables import table


def sql_hash(expr: str) -> str:
    return f"('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT"


# The three scorers and the weights the ensemble gives them.
SCORERS = {
    "a": ("l_quantity", 0.08, 25.0),
    "b": ("l_discount", 20.0, 0.05),
    "c": ("l_extendedprice", 0.00004, 38000.0),
}
SCORER_WEIGHTS = {"a": 0.4, "b": 0.4, "c": 0.2}

LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# One failure message per k % 10.
MESSAGES = {
    0: "container OOMKilled by kernel",
    1: "FileNotFoundError: no such file /data/in.csv",
    2: "ModuleNotFoundError: No module named 'numpy'",
    3: "request timed out after 300 s",
    4: "Permission denied for bucket",
    5: "connection refused by host",
    6: "insufficient cpu on node pool",
    7: "ImagePullBackOff for image repo/app",
    8: "ModuleNotFoundError raised while loading",
    9: "exit code 137 without details",
}


def feat(spark: SparkSession, sf: str) -> DataFrame:
    return feat_from(table(spark, sf, "events"))


def feat_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("id"),
        F.when(key_hash("event_id") % 20 == 0, None).otherwise(F.col("value")).alias("f1"),
        (F.col("value") - 20).alias("f2"),
        F.col("event_type").alias("cat"),
        (F.col("event_type") == "error").cast("int").alias("target"),
        "ts",
        F.floor(F.col("event_id") / 1000).alias("batch_id"),
    )


def li(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws(
            "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd")
        ).alias("key"),
        *LI_FEATURES,
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        "l_orderkey",
    )


def _logit(name: str) -> Column:
    column, slope, center = SCORERS[name]
    return F.lit(slope) * (F.col(column) - F.lit(center))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """One row per instance with the votes of the three scorers."""

    def vote(model: str) -> Column:
        p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-_logit(model)))
        return F.struct(
            F.lit(model).alias("model"),
            F.when(p1 > 0.5, 1).otherwise(0).alias("prediction"),
            F.array(F.lit(1.0) - p1, p1).alias("probabilities"),
        )

    return li(spark, sf).select("key", "l_orderkey", "y", F.array(*[vote(m) for m in SCORERS]).alias("votes"))


def scores_long(spark: SparkSession, sf: str) -> DataFrame:
    """One row per instance and model."""
    return scores(spark, sf).select("key", "l_orderkey", "y", F.explode("votes").alias("v")).select(
        "key",
        "l_orderkey",
        "y",
        F.col("v.model").alias("model"),
        F.col("v.prediction").alias("pred"),
        F.col("v.probabilities")[1].alias("p1"),
    )


def vec(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") > 4).cast("int").alias("y"),
        "label",
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def run_id() -> Column:
    """A run is one user's events within one page of 1000 events, so a run manifest is bounded."""
    return F.concat_ws("/", F.col("user_id"), F.floor(F.col("event_id") / 1000))


def run_nodes(spark: SparkSession, sf: str) -> DataFrame:
    k = _k()
    return table(spark, sf, "events").select(
        run_id().alias("run"),
        F.col("event_id").alias("node"),
        F.when(F.col("event_type") == "purchase", "gpu-train").otherwise(F.col("event_type")).alias("component"),
        F.lit("Pod").alias("type"),
        F.when((F.col("event_type") == "error") & (k % 2 == 0), "Failed")
        .when(F.col("event_type") == "error", "Error")
        .otherwise("Succeeded")
        .alias("status"),
        F.col("ts").cast("timestamp").alias("started"),
        F.when(k % 10 != 0, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.round(F.col("value") * 1000000).cast("long"))).alias("finished"),
        F.when(F.col("event_type") == "error", lookup(MESSAGES, k % 10)).otherwise("").alias("message"),
    )


def run_state(spark: SparkSession, sf: str) -> DataFrame:
    """Run-level record: state and error text, also for runs without any failed node."""
    return table(spark, sf, "events").groupBy(run_id().alias("run")).agg(
        F.count_if(F.col("event_type") == "error").alias("__errors"),
        F.min(F.col("ts").cast("timestamp")).alias("created"),
        F.max(F.col("ts").cast("timestamp")).alias("ended"),
    ).select(
        "run",
        F.when((F.col("__errors") > 0) | (key_hash("run") % 5 == 0), "Failed").otherwise("Succeeded").alias("state"),
        F.lit("deadline exceeded").alias("error"),
        "created",
        "ended",
    )


def ranked_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their 1-based position in their trial (= user)."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    ranked = rank_in_group(events, ["user_id"], [F.col("event_id")], id_order_bucket(F.col("event_id")), "step")
    return ranked.select(F.col("user_id").alias("trial"), (F.col("step") + 1).alias("step"), "event_id", "value")


def trials(spark: SparkSession, sf: str) -> DataFrame:
    """One row per trial: experiment, state, creation time and latest objective."""
    state = key_hash(F.lit("trial"), F.col("trial")) % 10
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("trial")).agg(
        F.min("ts").cast("timestamp").alias("created"),
        (F.max_by("value", "event_id") / 500).alias("accuracy"),
        F.max("event_id").alias("last_event"),
    ).select(
        "trial",
        F.floor(F.col("trial") / 5).alias("experiment"),
        F.when(state == 0, "Failed").when(state == 1, "Running").when(state == 2, "Pending").otherwise("Succeeded").alias("status"),
        "created",
        F.when(state > 2, F.col("accuracy")).alias("accuracy"),
    )


def trial_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_events(spark, sf).select(
        "trial", "step", F.lit("accuracy").alias("name"), (F.col("value") / 500).alias("value")
    )


def reqs(spark: SparkSession, sf: str) -> DataFrame:
    return reqs_from(table(spark, sf, "events"))


def reqs_from(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("request_id"),
        (F.col("user_id") % 5).alias("endpoint"),
        "ts",
        (F.col("value") * 10).alias("latency_ms"),
        (F.col("event_type") == "error").cast("int").alias("error"),
        F.col("event_type").isin("error", "purchase").cast("int").alias("prediction"),
        F.col("value").alias("feature_0"),
        _k().cast("double").alias("feature_1"),
    )


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    as_of = single_row(orders.agg(F.max("o_orderdate").alias("d")))["d"]
    return orders.select(
        F.col("o_orderkey").alias("path"),
        F.col("o_orderpriority").alias("type"),
        F.date_diff(as_of.cast("date"), F.col("o_orderdate").cast("date")).alias("age_days"),
        (F.col("o_totalprice") / 1000).alias("size_mb"),
    )


def cache_runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run"),
        F.col("o_custkey").alias("dataset"),
        (F.col("o_orderstatus") == "F").alias("hit"),
        F.when(key_hash("o_orderkey") % 20 != 0, F.col("o_totalprice") / 100).alias("duration"),
        F.col("o_orderdate").alias("created"),
    )


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "feat": ((), f"""
        SELECT event_id AS id,
               CASE WHEN {sql_hash('event_id')} % 20 = 0 THEN NULL ELSE value END AS f1,
               value - 20 AS f2, event_type AS cat,
               CAST(event_type = 'error' AS INTEGER) AS target, ts, event_id // 1000 AS batch_id
        FROM events"""),
    "li": ((), """
        SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d')) AS key,
               l_quantity, l_extendedprice, l_discount, l_tax,
               CAST(l_returnflag = 'R' AS INTEGER) AS y, l_orderkey
        FROM lineitem"""),
    "li_split": (("li",), f"""
        SELECT *, CASE WHEN {sql_hash('key')} % 1000 < 200 THEN 'test' ELSE 'train' END AS split FROM li"""),
    "scores": (("li",), """
        SELECT key, l_orderkey, y, model, ord, p1, CAST(p1 > 0.5 AS INTEGER) AS pred, w FROM (
          SELECT key, l_orderkey, y, 'a' AS model, 0 AS ord, 0.4 AS w,
                 1.0 / (1.0 + exp(-(0.08::DOUBLE * (l_quantity - 25.0::DOUBLE)))) AS p1 FROM li
          UNION ALL
          SELECT key, l_orderkey, y, 'b', 1, 0.4,
                 1.0 / (1.0 + exp(-(20.0::DOUBLE * (l_discount - 0.05::DOUBLE)))) FROM li
          UNION ALL
          SELECT key, l_orderkey, y, 'c', 2, 0.2,
                 1.0 / (1.0 + exp(-(0.00004::DOUBLE * (l_extendedprice - 38000.0::DOUBLE)))) FROM li)"""),
    "weighted": (("scores",), """
        SELECT key, any_value(y) AS y, sum(w * p1) / sum(w) AS wp,
               CAST(round(sum(w * p1) / sum(w), 9) > 0.5 AS INTEGER) AS pred
        FROM scores GROUP BY key"""),
    "vec": ((), """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features,
               CAST(label > 4 AS INTEGER) AS y, label FROM embeddings"""),
    "ev": ((), """
        SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""),
    "run_nodes": (("ev",), """
        SELECT user_id || '/' || event_id // 1000 AS run, event_id AS node,
               CASE WHEN event_type = 'purchase' THEN 'gpu-train' ELSE event_type END AS component,
               'Pod' AS type,
               CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'Failed'
                    WHEN event_type = 'error' THEN 'Error' ELSE 'Succeeded' END AS status,
               ts AS started,
               CASE WHEN k % 10 <> 0 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS finished,
               CASE WHEN event_type = 'error' THEN CASE k % 10
                 WHEN 0 THEN 'container OOMKilled by kernel'
                 WHEN 1 THEN 'FileNotFoundError: no such file /data/in.csv'
                 WHEN 2 THEN 'ModuleNotFoundError: No module named ''numpy'''
                 WHEN 3 THEN 'request timed out after 300 s'
                 WHEN 4 THEN 'Permission denied for bucket'
                 WHEN 5 THEN 'connection refused by host'
                 WHEN 6 THEN 'insufficient cpu on node pool'
                 WHEN 7 THEN 'ImagePullBackOff for image repo/app'
                 WHEN 8 THEN 'ModuleNotFoundError raised while loading'
                 ELSE 'exit code 137 without details' END ELSE '' END AS message
        FROM ev"""),
    "node_times": (("run_nodes",), """
        SELECT *, CAST(epoch_us(finished) - epoch_us(started) AS DOUBLE) / 1000000 AS duration FROM run_nodes"""),
    "run_state": ((), f"""
        SELECT run, CASE WHEN errors > 0 OR {sql_hash('run')} % 5 = 0 THEN 'Failed' ELSE 'Succeeded' END AS state,
               'deadline exceeded' AS error, created, ended
        FROM (SELECT user_id || '/' || event_id // 1000 AS run, count(*) FILTER (event_type = 'error') AS errors,
                     min(ts) AS created, max(ts) AS ended FROM events GROUP BY 1)"""),
    "trial_metrics": ((), """
        SELECT user_id AS trial, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step,
               'accuracy' AS name, value / 500 AS value, event_id
        FROM events"""),
    "trials": ((), f"""
        SELECT trial, trial // 5 AS experiment, CASE st WHEN 0 THEN 'Failed' WHEN 1 THEN 'Running' WHEN 2 THEN 'Pending' ELSE 'Succeeded' END AS status,
               created, CASE WHEN st > 2 THEN accuracy END AS accuracy
        FROM (SELECT user_id AS trial, {sql_hash("'trial-' || user_id")} % 10 AS st, min(ts) AS created,
                     arg_max(value, event_id) / 500 AS accuracy FROM events GROUP BY user_id)"""),
    "trial_params": (("trials",), f"""
        SELECT trial, 50 + 50 * (g // 72) AS n_estimators, 5 + 5 * (g // 18 % 4) AS max_depth, 2 + 4 * (g // 6 % 3) AS min_samples_split,
               round(0.3::DOUBLE + 0.3::DOUBLE * (g // 2 % 3), 6) AS max_features_ratio, CASE WHEN g % 2 = 0 THEN 'gini' ELSE 'entropy' END AS criterion
        FROM (SELECT trial, {sql_hash("trial")} % 288 AS g FROM trials)"""),
    "reqs": (("ev",), """
        SELECT event_id AS request_id, user_id % 5 AS endpoint, ts, value * 10 AS latency_ms,
               CAST(event_type = 'error' AS INTEGER) AS error,
               CAST(event_type IN ('error', 'purchase') AS INTEGER) AS prediction,
               value AS feature_0, CAST(k AS DOUBLE) AS feature_1
        FROM ev"""),
    "artifacts": ((), """
        SELECT o_orderkey AS path, o_orderpriority AS type,
               date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS age_days,
               o_totalprice / 1000 AS size_mb
        FROM orders"""),
    "cache_runs": ((), f"""
        SELECT o_orderkey AS run, o_custkey AS dataset, o_orderstatus = 'F' AS hit,
               CASE WHEN {sql_hash('o_orderkey')} % 20 <> 0 THEN o_totalprice / 100 END AS duration,
               o_orderdate AS created
        FROM orders"""),
}


def with_views(names: tuple[str, ...], sql: str) -> str:
    """Prefix `sql` with the views it names and those they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + "\n" + sql
