"""Search spaces, trials, metric logs and synthetic tables keyed by the given tables."""

from pyspark.sql import functions as F

from millrace.functions.hashing import key_hash
from millrace.functions.prefix import id_order_bucket, rank_in_group
from millrace.functions.scalars import ts_text
from millrace.operators import search
from millrace.plans.fixtures import sql_hash, trial_metrics, trials
from millrace.plans.registry import query
from millrace.session import materialize, scratch_path
from millrace.sources import synth
from millrace.sources.files import append_lines
from millrace.sources.tables import table

GRID_NAMES = ["n-estimators", "max-depth", "min-samples-split", "max-features-ratio", "criterion"]


def sql_uniform(key: str, salt: str) -> str:
    return f"""(({sql_hash(f"{key} || '-{salt}'")} + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"""


def sql_normal(key: str, salt: str) -> str:
    r, a = sql_uniform(key, salt + "/r"), sql_uniform(key, salt + "/a")
    return f"(sqrt(-2.0::DOUBLE * ln({r})) * cos(6.283185307179586::DOUBLE * {a}))"


def trial_params(spark, sf):
    size = search.grid_size(search.GRID_SPACE)
    return search.with_grid_point(trials(spark, sf), key_hash("trial") % size, search.GRID_SPACE)


@query("grid_space", "SELECT * FROM trial_params", views=("trial_params",))
def grid_space(spark, sf):
    return trial_params(spark, sf).select("trial", *[p.name for p in search.GRID_SPACE])


@query(
    "random_space",
    f"""
    SELECT trial, CAST(floor({sql_uniform('trial', '42/n_estimators')} * 251) AS BIGINT) + 50 AS n_estimators,
           CAST(floor({sql_uniform('trial', '42/max_depth')} * 18) AS BIGINT) + 3 AS max_depth,
           CAST(floor({sql_uniform('trial', '42/min_samples_split')} * 19) AS BIGINT) + 2 AS min_samples_split,
           CAST(floor({sql_uniform('trial', '42/min_samples_leaf')} * 10) AS BIGINT) + 1 AS min_samples_leaf,
           round(0.1::DOUBLE + {sql_uniform('trial', '42/max_features_ratio')} * 0.9::DOUBLE, 6) AS max_features_ratio,
           ['gini', 'entropy', 'log_loss'][CAST(floor({sql_uniform('trial', '42/criterion')} * 3) AS BIGINT) + 1] AS criterion,
           ['true', 'false'][CAST(floor({sql_uniform('trial', '42/bootstrap')} * 2) AS BIGINT) + 1] AS bootstrap
    FROM trials
    """,
    views=("trials",),
)
def random_space(spark, sf):
    out = search.random_space(trials(spark, sf).select("trial"), "trial", search.RANDOM_SPACE)
    return out.withColumn("max_features_ratio", F.round("max_features_ratio", 6))


@query(
    "trial_assignments",
    """
    SELECT trial, name, value FROM (SELECT trial, 'n_estimators' AS name, CAST(n_estimators AS VARCHAR) AS value FROM trial_params
      UNION ALL SELECT trial, 'max_depth', CAST(max_depth AS VARCHAR) FROM trial_params
      UNION ALL SELECT trial, 'criterion', criterion FROM trial_params)
    """,
    views=("trial_params",),
)
def trial_assignments(spark, sf):
    return search.assignments(trial_params(spark, sf), "trial", ["n_estimators", "max_depth", "criterion"])


def stored_metrics(spark, sf):
    """The trial metrics as a table of their own, for operators that read them several times."""
    return materialize(trial_metrics(spark, sf), "trial-metrics")


@query(
    "halving_rungs",
    f"""
    , r AS (SELECT trial, step, value, row_number() OVER (PARTITION BY step ORDER BY value DESC, {sql_hash('trial')}, trial) AS rk,
                   count(*) OVER (PARTITION BY step) AS n FROM trial_metrics)
    SELECT trial, step, round(value, 6) AS value, rk <= n // 3 AS promoted FROM r
    """,
    views=("trial_metrics",),
)
def halving_rungs(spark, sf):
    out = search.halving_rungs(stored_metrics(spark, sf), eta=3)
    return out.select("trial", "step", F.round("value", 6).alias("value"), "promoted")


SCHEDULE = search.halving_schedule(27)


@query(
    "halving_brackets",
    f"""
    , d AS (SELECT trial, rk // 49 AS round, CASE WHEN rk % 49 < 27 THEN 3 WHEN rk % 49 < 39 THEN 2 WHEN rk % 49 < 45 THEN 1 ELSE 0 END AS bracket
            FROM (SELECT trial, row_number() OVER (ORDER BY trial) - 1 AS rk FROM trials)),
    m AS (SELECT trial, step, CASE WHEN h % 13 = 0 THEN NULL WHEN h % 17 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END AS value
          FROM (SELECT *, {sql_hash("'m-' || trial || '-' || step")} AS h FROM trial_metrics))
    SELECT round, bracket, rung, resource, trial, round(value, 6) AS value, promoted FROM (
        WITH RECURSIVE rungs AS (
            SELECT round, bracket, 0 AS rung, CAST(27 // pow(3, bracket) AS BIGINT) AS resource, trial, NULL::DOUBLE AS value, true AS alive, false AS promoted FROM d
            UNION ALL
            SELECT round, bracket, rung + 1, resource * 3, trial, value, false,
                   coalesce(good, false) AND row_number() OVER (PARTITION BY round, bracket ORDER BY CASE WHEN good THEN -value END NULLS LAST, trial)
                       <= count(*) OVER (PARTITION BY round, bracket) // 3 AND rung < bracket
            FROM (SELECT r.round, r.bracket, r.rung, r.resource, r.trial, m.value, m.value IS NOT NULL AND NOT isnan(m.value) AS good
                  FROM rungs r LEFT JOIN m ON m.trial = r.trial AND m.step = r.resource WHERE r.alive OR r.promoted)
        )
        SELECT round, bracket, rung - 1 AS rung, resource // 3 AS resource, trial, value, promoted FROM rungs WHERE NOT alive
    )
    """,
    views=("trial_metrics", "trials"),
)
def halving_brackets(spark, sf):
    """Brackets of up to 27 steps: what each rung ranks is what the rung before kept."""
    own = trials(spark, sf).select("trial")
    ranked = rank_in_group(own, [], [F.col("trial")], id_order_bucket(F.col("trial")), "rank").select("trial", "rank")
    h = key_hash(F.lit("m"), F.col("trial"), F.col("step"))
    value = F.when(h % 13 == 0, None).when(h % 17 == 0, float("nan")).otherwise(F.col("value"))
    metrics = trial_metrics(spark, sf).select("trial", "step", value.alias("value"))
    out = search.halving_brackets(search.deal_brackets(ranked, SCHEDULE), metrics, SCHEDULE)
    return out.withColumn("value", F.round("value", 6))


@query(
    "median_stop",
    """
    , m AS (SELECT step, quantile_cont(value, 0.5) AS med, count(*) AS n FROM trial_metrics GROUP BY step)
    SELECT trial, min(step) FILTER (step >= 2 AND n >= 3 AND value < med) AS stop_step FROM trial_metrics JOIN m USING (step) GROUP BY trial
    """,
    views=("trial_metrics",),
)
def median_stop(spark, sf):
    return search.median_stop(stored_metrics(spark, sf))


@query(
    "latest_metrics",
    "SELECT trial, name, round(arg_max(value, step), 6) AS latest, max(step) AS last_step FROM trial_metrics GROUP BY trial, name",
    views=("trial_metrics",),
)
def latest_metrics(spark, sf):
    return search.latest_metrics(trial_metrics(spark, sf)).withColumn("latest", F.round("latest", 6))


@query(
    "best_trial",
    """
    SELECT experiment, trial, round(accuracy, 6) AS accuracy, n_estimators, max_depth, criterion
    FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY accuracy DESC, trial) AS rk FROM trials WHERE accuracy IS NOT NULL)
    JOIN trial_params USING (trial) WHERE rk = 1
    """,
    views=("trial_params",),
)
def best_trial(spark, sf):
    out = search.best_trial(trial_params(spark, sf), ["experiment"], "accuracy")
    return out.select("experiment", "trial", F.round("accuracy", 6).alias("accuracy"), "n_estimators", "max_depth", "criterion")


@query(
    "trial_progress",
    """
    SELECT experiment, count(*) FILTER (status = 'Succeeded') AS succeeded, count(*) FILTER (status = 'Failed') AS failed,
           count(*) FILTER (status = 'Running') AS running, count(*) FILTER (status = 'Pending') AS pending,
           count(*) FILTER (status IN ('Succeeded', 'Failed')) * 100 // 5 AS progress FROM trials GROUP BY experiment
    """,
    views=("trials",),
)
def trial_progress(spark, sf):
    return search.trial_progress(trials(spark, sf), "experiment", 5)


STATUS = """
    , f AS (SELECT experiment, max(accuracy) AS best, count(*) FILTER (status IN ('Succeeded', 'Failed')) AS finished,
                   count(*) FILTER (status = 'Failed') AS failed FROM trials GROUP BY experiment),
    e AS (SELECT experiment, round(best, 6) AS best, finished, failed, coalesce(best >= 0.5, false) AS goal_reached, finished >= 4 AS max_trials_reached,
                 failed > 1 AS max_failures_reached,
                 CASE WHEN failed > 1 THEN 'Failed' WHEN coalesce(best >= 0.5, false) OR finished >= 4 THEN 'Succeeded' ELSE 'Running' END AS state FROM f)
"""


def experiments(spark, sf):
    out = search.experiment_status(trials(spark, sf), "experiment", "accuracy", 0.5, 4, 1)
    return out.withColumn("best", F.round("best", 6))


@query("experiment_status", STATUS + "SELECT * FROM e", views=("trials",))
def experiment_status(spark, sf):
    return experiments(spark, sf)


@query("cleanup_candidates", STATUS + "SELECT experiment, state FROM e WHERE state = 'Succeeded'", views=("trials",))
def cleanup_candidates(spark, sf):
    return search.cleanup_candidates(experiments(spark, sf), "completed").select("experiment", "state")


@query(
    "recent_trials",
    """
    SELECT trial, status, strftime(created, '%Y-%m-%d %H:%M:%S.%f') AS created, round(accuracy, 6) AS accuracy
    FROM trials ORDER BY trials.created DESC, trial LIMIT 8
    """,
    views=("trials",),
)
def recent_trials(spark, sf):
    out = search.recent_trials(trials(spark, sf))
    return out.select("trial", "status", ts_text(F.col("created")).alias("created"), F.round("accuracy", 6).alias("accuracy"))


@query(
    "render_params",
    """
    SELECT trial,
      '{"n-estimators":"' || n_estimators || '","max-depth":"' || max_depth || '","min-samples-split":"' || min_samples_split
        || '","max-features-ratio":"' || CAST(CAST(max_features_ratio AS DOUBLE) AS VARCHAR) || '","criterion":"' || criterion || '"}' AS as_json,
      'export N_ESTIMATORS="' || n_estimators || '"' || chr(10) || 'export MAX_DEPTH="' || max_depth || '"' || chr(10)
        || 'export MIN_SAMPLES_SPLIT="' || min_samples_split || '"' || chr(10) || 'export MAX_FEATURES_RATIO="' || CAST(CAST(max_features_ratio AS DOUBLE) AS VARCHAR)
        || '"' || chr(10) || 'export CRITERION="' || criterion || '"' AS as_env,
      '  n-estimators: ' || n_estimators || chr(10) || '  max-depth: ' || max_depth || chr(10) || '  min-samples-split: ' || min_samples_split || chr(10)
        || '  max-features-ratio: ' || CAST(CAST(max_features_ratio AS DOUBLE) AS VARCHAR) || chr(10) || '  criterion: ' || criterion AS as_yaml,
      '--n-estimators=' || n_estimators || ' --max-depth=' || max_depth || ' --min-samples-split=' || min_samples_split
        || ' --max-features-ratio=' || CAST(CAST(max_features_ratio AS DOUBLE) AS VARCHAR) || ' --criterion=' || criterion AS as_cli
    FROM trial_params
    """,
    views=("trial_params",),
)
def render_params(spark, sf):
    return search.render_params(trial_params(spark, sf), GRID_NAMES).select("trial", "as_json", "as_env", "as_yaml", "as_cli")


@query(
    "render_trial_args",
    """
    SELECT trial, 'python train.py --n-estimators=' || n_estimators || ' --max-depth=' || max_depth || ' --criterion=' || criterion || ' --num-epochs=5' AS command
    FROM trial_params
    """,
    views=("trial_params",),
)
def render_trial_args(spark, sf):
    template = (
        "python train.py --n-estimators=${trialParameters.nEstimators} --max-depth=${trialParameters.maxDepth}"
        " --criterion=${trialParameters.criterion} --num-epochs=5"
    )
    return search.render_template(trial_params(spark, sf), template, GRID_NAMES).select("trial", "command")


METRIC_ROWS = """
    SELECT trial, CAST(CASE WHEN step % 2 = 0 THEN step END AS INTEGER) AS step, name, round(value, 6) AS value FROM trial_metrics
    UNION ALL SELECT trial, NULL, 'accuracy', 0.0 FROM trials WHERE status = 'Failed'
"""


def logged_metrics(spark, sf):
    """Even steps are logged with their epoch, odd ones as a bare name=value line."""
    return trial_metrics(spark, sf).withColumn("step", F.when(F.col("step") % 2 == 0, F.col("step")))


@query("metric_log_parse", METRIC_ROWS, views=("trial_metrics", "trials"))
def metric_log_parse(spark, sf):
    lines = search.metric_lines(logged_metrics(spark, sf), ["trial"])
    failed = trials(spark, sf).where("status = 'Failed'")
    return search.with_failed_objective(search.parse_metric_lines(lines, "line", ["trial"]), failed, "accuracy")


@query(
    "metric_log_sink",
    """
    SELECT CAST(trial % 5 AS INTEGER) AS experiment, trial, CASE WHEN step % 2 = 0 THEN step END AS step, name, round(value, 6) AS value FROM trial_metrics
    """,
    views=("trial_metrics",),
)
def metric_log_sink(spark, sf):
    """Lines with their trial, appended to text files by experiment, then read back and parsed."""
    rows = logged_metrics(spark, sf).withColumn("experiment", F.col("trial") % 5)
    lines = search.metric_lines(rows, ["experiment", "trial"])
    tagged = lines.select("experiment", F.concat(F.lit("["), F.col("trial").cast("string"), F.lit("] "), "line").alias("line"))
    read = spark.read.text(append_lines(tagged, "line", scratch_path(spark, "metric-log")))
    parts = read.select("experiment", F.regexp_extract("value", r"^\[(-?\d+)\] ", 1).cast("long").alias("trial"), F.regexp_replace("value", r"^\[-?\d+\] ", "").alias("value"))
    return search.parse_metric_lines(parts, "value", ["experiment", "trial"]).select("experiment", "trial", "step", "name", "value")


def event_keys(spark, sf):
    return table(spark, sf, "events").select(F.col("event_id").alias("id"))


@query(
    "synth_table",
    f"""
    WITH k AS (SELECT event_id AS id, row_number() OVER (ORDER BY {sql_hash("event_id || '-42/null'")}, event_id) - 1 AS rk,
                      count(*) OVER () AS n FROM events)
    SELECT id, CASE WHEN rk >= floor(0.05::DOUBLE * n) THEN round({sql_normal('id', '42/1')}, 6) END AS feature_1,
           round(-2.0::DOUBLE * ln({sql_uniform('id', '42/2')}), 6) AS feature_2,
           ['A', 'B', 'C'][CAST(floor({sql_uniform('id', '42/3')} * 3) AS BIGINT) + 1] AS feature_3,
           CAST({sql_uniform('id', '42/t')} < 0.3 AS INTEGER) AS target, 1704067200 + id * 60 AS epoch_seconds,
           round({sql_uniform('id', '42/4')} * 2 - 1, 6) AS feature_4,
           round(-2.0::DOUBLE * ln({sql_uniform('id', '42/5a')}) - 2.0::DOUBLE * ln({sql_uniform('id', '42/5b')}), 6) AS feature_5
    FROM k
    """,
)
def synth_table(spark, sf):
    out = synth.feature_table(event_keys(spark, sf), wide=True)
    rounded = [F.round(f"feature_{i}", 6).alias(f"feature_{i}") for i in (1, 2, 4, 5)]
    return out.select("id", *rounded, "feature_3", "target", F.unix_seconds("timestamp").alias("epoch_seconds"))


@query(
    "synth_imbalanced",
    f"""
    WITH k AS (SELECT event_id AS id, CAST({sql_uniform('event_id', '42/class')} < 0.03 AS INTEGER) AS "Class" FROM events)
    SELECT id, "Class", round({sql_normal('id', '42/Amount')} + "Class" * 1.5::DOUBLE, 6) AS "Amount", round({sql_normal('id', '42/Time')}, 6) AS "Time",
           round({sql_normal('id', '42/V1')} + "Class" * 1.5::DOUBLE, 6) AS "V1", round({sql_normal('id', '42/V28')}, 6) AS "V28" FROM k
    """,
)
def synth_imbalanced(spark, sf):
    out = synth.imbalanced_table(event_keys(spark, sf))
    return out.select("id", "Class", *[F.round(c, 6).alias(c) for c in ("Amount", "Time", "V1", "V28")])


@query(
    "synth_rule_label",
    f"""
    WITH k AS (SELECT event_id AS id, {', '.join(f"{sql_normal('event_id', f'42/x{i}')} AS x{i}" for i in range(7))},
                      row_number() OVER (ORDER BY {sql_hash("event_id || '-42/flip'")}, event_id) - 1 AS rk, count(*) OVER () AS n FROM events),
    c AS (SELECT *, CAST((x0 > 0 AND x1 > 0) OR x2 * x2 + x3 * x3 > 1 OR x4 > 1.5 OR x5 * x6 > 0.5 AS INTEGER) AS clean_label FROM k)
    SELECT id, round(x0, 6) AS feature_0, clean_label, CASE WHEN rk < floor(0.1::DOUBLE * n) THEN 1 - clean_label ELSE clean_label END AS label FROM c
    """,
)
def synth_rule_label(spark, sf):
    out = synth.rule_label_table(event_keys(spark, sf))
    return out.select("id", F.round("feature_0", 6).alias("feature_0"), "clean_label", "label")


@query(
    "synth_uniform_batch",
    f"""
    SELECT event_id AS id, {', '.join(f"round({sql_uniform('event_id', f'42/u{i}')} * 3.0::DOUBLE + 2.0::DOUBLE, 6) AS u{i}" for i in (0, 7, 29))} FROM events
    """,
)
def synth_uniform_batch(spark, sf):
    out = synth.uniform_batch(event_keys(spark, sf))
    return out.select("id", *[F.round(F.col("features")[i], 6).alias(f"u{i}") for i in (0, 7, 29)])
