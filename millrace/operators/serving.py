"""Prediction records for scored instances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import ratio

# Labels and risk limits of the record format.
POSITIVE_LABEL, NEGATIVE_LABEL = "fraud", "legitimate"
HIGH_RISK, MEDIUM_RISK = 0.8, 0.5


def class_label(prediction: Column) -> Column:
    return F.when(prediction == 1, POSITIVE_LABEL).otherwise(NEGATIVE_LABEL)


def risk_level(positive_probability: Column) -> Column:
    return (
        F.when(positive_probability >= HIGH_RISK, "high")
        .when(positive_probability >= MEDIUM_RISK, "medium")
        .when(positive_probability.isNotNull(), "low")
    )


def decide(probability: Column, threshold: float = 0.5) -> Column:
    """Class 1 at or above the stored decision threshold."""
    return F.when(probability >= threshold, 1).otherwise(0)


def format_predictions(
    df: DataFrame,
    prediction: str = "prediction",
    probabilities: str = "probabilities",
    metadata: DataFrame | None = None,
    on: Sequence[str] = (),
) -> DataFrame:
    """Add label, confidence of the predicted class, the probability record and the risk
    level; metadata may cover only some rows."""
    out = df.withColumns(
        {
            "prediction_label": class_label(F.col(prediction)),
            "confidence": F.get(probabilities, F.col(prediction)),
            "class_probabilities": F.struct(
                F.get(probabilities, 0).alias(NEGATIVE_LABEL), F.get(probabilities, 1).alias(POSITIVE_LABEL)
            ),
            "risk_level": risk_level(F.get(probabilities, 1)),
        }
    )
    return out if metadata is None else out.join(metadata, list(on), "left")


def service_counters(requests: DataFrame, keys: Sequence[str] = (), latency_ms: str = "latency_ms", error: str = "error") -> DataFrame:
    """Requests, errors and mean latency; 0 when there are none."""
    return requests.groupBy(*keys).agg(
        F.count("*").alias("total_requests"),
        F.coalesce(F.sum(error), F.lit(0)).alias("error_count"),
        ratio(F.sum(latency_ms), F.count(latency_ms).cast("double")).alias("avg_latency_ms"),
    )
