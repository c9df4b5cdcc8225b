"""Ensembles, prediction records and evaluation over the three fixed scorers."""

from pyspark.sql import functions as F

from millrace.operators import ensemble, evaluation, serving, splits
from millrace.plans.fixtures import SCORER_WEIGHTS, scores, scores_long
from millrace.plans.registry import query
from millrace.sources.tables import table

CLASSES = [0, 1]


def weighted_predictions(spark, sf):
    combined = ensemble.combine(scores(spark, sf), "weighted_average", SCORER_WEIGHTS, classes=len(CLASSES))
    return combined.select(
        "key", "y", F.col("prediction").alias("pred"), F.col("mean_probabilities")[1].alias("p1"), "confidence"
    )


@query(
    "ensemble_report",
    """
    , tally AS (
      SELECT c.label, count(*) FILTER (y = c.label AND pred = c.label) AS tp,
             count(*) FILTER (y = c.label) AS support, count(*) FILTER (pred = c.label) AS predicted
      FROM weighted, (VALUES (0), (1)) c(label) GROUP BY c.label),
    m AS (
      SELECT CAST(label AS VARCHAR) AS label, coalesce(tp / nullif(predicted, 0), 0.0) AS p,
             coalesce(tp / nullif(support, 0), 0.0) AS r,
             coalesce(2.0 * tp / nullif(predicted + support, 0), 0.0) AS f, support FROM tally)
    SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM m
    UNION ALL
    SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM m
    UNION ALL
    SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
           round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
    """,
    views=("weighted",),
)
def ensemble_report(spark, sf):
    report = evaluation.class_report(weighted_predictions(spark, sf), CLASSES)
    return report.select("label", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query(
    "ensemble_majority",
    """
    SELECT key, CAST(CASE WHEN sum(pred) * 2 > count(*) THEN 1 ELSE 0 END AS INTEGER) AS prediction,
           round(greatest(sum(pred), count(*) - sum(pred)) / count(*), 6) AS confidence
    FROM scores GROUP BY key
    """,
    views=("scores",),
)
def ensemble_majority(spark, sf):
    return ensemble.combine(scores(spark, sf), "majority_vote").select(
        "key", "prediction", F.round("confidence", 6).alias("confidence")
    )


@query(
    "ensemble_weighted",
    """
    SELECT key, pred AS prediction, round(CASE WHEN pred = 1 THEN wp ELSE 1 - wp END, 6) AS confidence,
           round(wp, 6) AS positive_probability
    FROM weighted
    """,
    views=("weighted",),
)
def ensemble_weighted(spark, sf):
    return weighted_predictions(spark, sf).select(
        "key",
        F.col("pred").alias("prediction"),
        F.round("confidence", 6).alias("confidence"),
        F.round("p1", 6).alias("positive_probability"),
    )


@query(
    "ensemble_max_conf",
    """
    SELECT key, pred AS prediction, conf AS confidence, model AS selected_model FROM (
      SELECT *, row_number() OVER (PARTITION BY key ORDER BY conf DESC, ord) AS rn
      FROM (SELECT *, round(greatest(p1, 1 - p1), 6) AS conf FROM scores)) WHERE rn = 1
    """,
    views=("scores",),
)
def ensemble_max_conf(spark, sf):
    return ensemble.max_confidence(scores(spark, sf), digits=6).select(
        "key", "prediction", "confidence", "selected_model"
    )


@query(
    "ensemble_dispatch",
    """
    , best AS (SELECT key, pred FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY conf DESC, ord) AS rn
               FROM (SELECT *, round(greatest(p1, 1 - p1), 9) AS conf FROM scores)) WHERE rn = 1)
    SELECT key, 'majority_vote' AS method, CAST(count(*) AS INTEGER) AS num_models, string_agg(model, ',' ORDER BY ord) AS models,
           CAST(CASE WHEN sum(pred) * 2 > count(*) THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM scores GROUP BY key
    UNION ALL SELECT key, 'max_confidence', 3, 'a,b,c', pred FROM best
    """,
    views=("scores",),
)
def ensemble_dispatch(spark, sf):
    """Two methods by name, each with its aggregation record."""
    rows = scores(spark, sf)
    parts = [ensemble.combine(rows, method).select("key", "method", "num_models", F.array_join("models", ",").alias("models"), "prediction") for method in ("majority_vote", "max_confidence")]
    return parts[0].union(parts[1])


@query(
    "ensemble_rows",
    """
    SELECT key AS instance, CAST(CASE WHEN sum(pred) * 2 > count(*) THEN 1 ELSE 0 END AS INTEGER) AS prediction,
           round(greatest(sum(pred), count(*) - sum(pred)) / count(*), 6) AS confidence,
           CAST(count(*) AS INTEGER) AS num_models, string_agg(model, ',' ORDER BY ord) AS models
    FROM scores GROUP BY key
    """,
    views=("scores",),
)
def ensemble_rows(spark, sf):
    """Votes gathered from a table with one row per instance and model."""
    rows = scores_long(spark, sf).select(
        F.col("key").alias("instance"),
        "model",
        F.col("pred").alias("prediction"),
        F.array(1 - F.col("p1"), F.col("p1")).alias("probabilities"),
    )
    combined = ensemble.combine(ensemble.votes_from_rows(rows, "instance", ["a", "b", "c"]), "majority_vote")
    return combined.select("instance", "prediction", F.round("confidence", 6).alias("confidence"), "num_models", F.array_join("models", ",").alias("models"))


@query(
    "format_prediction",
    """
    SELECT s.key, s.pred AS prediction, CASE WHEN s.pred = 1 THEN 'fraud' ELSE 'legitimate' END AS prediction_label,
           round(CASE WHEN s.pred = 1 THEN wp ELSE 1 - wp END, 6) AS confidence,
           round(1 - wp, 6) AS p_legitimate, round(wp, 6) AS p_fraud, o.o_orderpriority AS note
    FROM weighted s JOIN (SELECT key, any_value(l_orderkey) AS ok FROM li GROUP BY key) k ON s.key = k.key
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON o.o_orderkey = k.ok
    """,
    views=("weighted",),
)
def format_prediction(spark, sf):
    combined = ensemble.combine(scores(spark, sf), "weighted_average", SCORER_WEIGHTS, classes=len(CLASSES))
    notes = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("note")
    )
    formatted = serving.format_predictions(
        combined.withColumnRenamed("mean_probabilities", "probabilities"), metadata=notes, on=["l_orderkey"]
    )
    return formatted.select(
        "key",
        "prediction",
        "prediction_label",
        F.round("confidence", 6).alias("confidence"),
        F.round("class_probabilities.legitimate", 6).alias("p_legitimate"),
        F.round("class_probabilities.fraud", 6).alias("p_fraud"),
        "note",
    )


@query(
    "risk_level",
    """
    SELECT key, model, CASE WHEN round(p1, 9) >= 0.8 THEN 'high' WHEN round(p1, 9) >= 0.5 THEN 'medium' ELSE 'low' END AS risk_level
    FROM scores
    """,
    views=("scores",),
)
def risk_level(spark, sf):
    return scores_long(spark, sf).select("key", "model", serving.risk_level(F.round("p1", 9)).alias("risk_level"))


@query("eval_accuracy", "SELECT model, round(avg(CAST(y = pred AS INTEGER)), 6) AS accuracy FROM scores GROUP BY model", views=("scores",))
def eval_accuracy(spark, sf):
    out = evaluation.accuracy(scores_long(spark, sf), ["model"])
    return out.select("model", F.round("accuracy", 6).alias("accuracy"))


TALLY = """
    , tally AS (
      SELECT model, c.label, count(*) FILTER (y = c.label AND pred = c.label) AS tp,
             count(*) FILTER (y = c.label) AS support, count(*) FILTER (pred = c.label) AS predicted
      FROM scores, (VALUES (0), (1)) c(label) GROUP BY model, c.label),
    m AS (
      SELECT model, CAST(label AS VARCHAR) AS label, coalesce(tp / nullif(predicted, 0), 0.0) AS p,
             coalesce(tp / nullif(support, 0), 0.0) AS r,
             coalesce(2.0 * tp / nullif(predicted + support, 0), 0.0) AS f, support FROM tally),
    report AS (
      SELECT model, label, p, r, f, support FROM m
      UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM m GROUP BY model
      UNION ALL SELECT model, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                       sum(f * support) / sum(support), sum(support) FROM m GROUP BY model)
"""


@query(
    "eval_weighted",
    TALLY + """
    SELECT model, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM report WHERE label = 'weighted avg'
    """,
    views=("scores",),
)
def eval_weighted(spark, sf):
    out = evaluation.weighted_scores(scores_long(spark, sf), CLASSES, ["model"])
    return out.select("model", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")])


@query(
    "eval_report",
    TALLY + """
    SELECT model, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
           CAST(support AS BIGINT) AS support FROM report
    """,
    views=("scores",),
)
def eval_report(spark, sf):
    out = evaluation.class_report(scores_long(spark, sf), CLASSES, ["model"])
    return out.select("model", "label", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query(
    "metric_records",
    TALLY + """
    SELECT model, 'class_' || replace(label, ' ', '_') || '_' || name AS name, round(value, 6) AS value, format FROM (
      SELECT model, label, 'precision' AS name, p AS value, 'PERCENTAGE' AS format FROM report
      UNION ALL SELECT model, label, 'recall', r, 'PERCENTAGE' FROM report
      UNION ALL SELECT model, label, 'f1', f, 'PERCENTAGE' FROM report
      UNION ALL SELECT model, label, 'support', CAST(support AS DOUBLE), 'RAW' FROM report)
    """,
    views=("scores",),
)
def metric_records(spark, sf):
    report = evaluation.class_report(scores_long(spark, sf), CLASSES, ["model"])
    records = evaluation.metric_records(report, ["model"])
    return records.select("model", "name", F.round("value", 6).alias("value"), "format")


@query(
    "confusion_matrix",
    """
    SELECT s.model, a.c AS actual, b.c AS predicted, count(*) FILTER (y = a.c AND pred = b.c) AS n
    FROM scores s, (VALUES (0), (1)) a(c), (VALUES (0), (1)) b(c) GROUP BY ALL
    """,
    views=("scores",),
)
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(scores_long(spark, sf), CLASSES, ["model"])


@query(
    "roc_auc",
    """
    , g AS (SELECT model, round(p1, 9) AS s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
            FROM scores GROUP BY ALL),
    c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT model, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM c GROUP BY model
    """,
    views=("scores",),
)
def roc_auc(spark, sf):
    rows = scores_long(spark, sf).withColumn("p1", F.round("p1", 9))
    return evaluation.roc_auc(rows, ["model"]).select("model", F.round("auc", 6).alias("auc"))


@query(
    "overfit_gap",
    f"""
    , t AS (SELECT model, CAST(y = pred AS INTEGER) AS hit, CASE WHEN
              ('0x' || substr(md5(key), 1, 8))::BIGINT % 1000 < 200 THEN 'test' ELSE 'train' END AS split FROM scores)
    SELECT model, round(avg(hit) FILTER (split = 'train'), 6) AS train_accuracy,
           round(avg(hit) FILTER (split = 'test'), 6) AS test_accuracy, round(avg(hit), 6) AS full_accuracy,
           round(avg(hit) FILTER (split = 'train') - avg(hit) FILTER (split = 'test'), 6) AS gap
    FROM t GROUP BY model
    """,
    views=("scores",),
)
def overfit_gap(spark, sf):
    rows = splits.random_split(scores(spark, sf), ["key"]).select("key", "y", "split", F.explode("votes").alias("v"))
    rows = rows.select("y", "split", F.col("v.model").alias("model"), F.col("v.prediction").alias("pred"))
    out = evaluation.overfit_gap(rows, keys=["model"])
    return out.select(
        "model", *[F.round(c, 6).alias(c) for c in ("train_accuracy", "test_accuracy", "full_accuracy", "gap")]
    )
