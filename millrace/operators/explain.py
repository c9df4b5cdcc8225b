"""Explanation records from per-feature contributions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.serving import class_label

# Wording of the explanation record.
UP, DOWN = "increases fraud risk", "decreases fraud risk"
TOP_DISPLAY, TOP_TEXT = 10, 3


def linear_contributions(df: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, train: DataFrame | None = None) -> DataFrame:
    """Add `base_value` and `contributions` for a linear model: weight * (value - mean). The means,
    a number per feature, are read first, so that the rows themselves are scanned once however
    often the contributions are used."""
    held = (df if train is None else train).agg(*[F.avg(f).alias(f) for f in weights]).first()
    means = {f: F.lit(held[f]).cast("double") for f in weights}
    base = sum((F.lit(w) * means[f] for f, w in weights.items()), F.lit(float(intercept)))
    items = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), (F.lit(w) * (F.col(f) - means[f])).alias("shap_value"))
            for f, w in weights.items()
        ]
    )
    return df.withColumns({"base_value": base, "contributions": items})


def rank_contributions(df: DataFrame) -> DataFrame:
    """Order contributions by size, largest first, feature order on ties, and add the
    direction text and the explained value (base plus all contributions)."""
    ranked = F.sort_array(
        F.transform(
            "contributions",
            lambda c, i: F.struct(
                (-F.abs(c["shap_value"])).alias("sort"),
                i.alias("position"),
                c["feature"].alias("feature"),
                c["value"].alias("value"),
                c["shap_value"].alias("shap_value"),
            ),
        )
    )
    all_features = F.transform(
        ranked,
        lambda c, i: F.struct(
            (i + 1).alias("rank"),
            c["feature"].alias("feature"),
            c["value"].alias("value"),
            c["shap_value"].alias("shap_value"),
            F.abs(c["shap_value"]).alias("abs_shap_value"),
            F.when(c["shap_value"] > 0, UP).otherwise(DOWN).alias("contribution"),
        ),
    )
    explained = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["shap_value"])
    return df.withColumns({"all_features": all_features, "prediction_value": explained})


def top_features(k: int = TOP_DISPLAY) -> Column:
    return F.slice("all_features", 1, k)


def explanation_rows(ranked: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """One row per instance and feature, optionally only the top k. The outer form keeps
    Spark from adding a non-empty filter that would compute the arrays twice."""
    return ranked.select(key, F.inline_outer(F.col("all_features") if k is None else top_features(k)))


def stored_rows(df: DataFrame, key: str, version: str) -> DataFrame:
    """Contributions for a table published by model version: a row per instance, so that its key
    is stored once, with a cell per feature."""
    cells = F.col("contributions").cast("array<struct<feature: string, value: double, contribution: double>>")
    return df.select(F.col(key), "base_value", cells.alias("cells"), F.lit(version).alias("model_version"))


def stored_cells(rows: DataFrame, key: str) -> DataFrame:
    """Published contributions as one row per instance and feature."""
    return rows.select("model_version", key, "base_value", F.inline_outer("cells"))


def explanation_text(prediction: Column, probability: Column) -> Column:
    """The sentence of the explanation record: class, confidence, three strongest factors."""
    head = F.format_string(
        "This transaction is predicted as %s with %.1f%% confidence. The most influential factors are:\n",
        F.upper(class_label(prediction)),
        F.when(prediction == 1, probability).otherwise(1 - probability) * 100,
    )
    lines = F.transform(
        top_features(TOP_TEXT),
        lambda c: F.format_string(
            "%d. %s (value: %.3f) %s by %.3f\n",
            c["rank"],
            c["feature"],
            c["value"],
            c["contribution"],
            c["abs_shap_value"],
        ),
    )
    return F.concat(head, F.array_join(lines, ""))


def chart_series(ranked: DataFrame) -> DataFrame:
    """Waterfall, force and bar series, each an aligned array per instance."""

    def part(field: str, items: Column) -> Column:
        return F.transform(items, lambda c: c[field]).alias(field)

    everything, top = F.col("all_features"), top_features()
    fields = ("feature", "value", "shap_value")
    return ranked.withColumns(
        {
            "waterfall": F.struct("base_value", *[part(f, top) for f in fields]),
            "force": F.struct("base_value", *[part(f, everything) for f in fields]),
            "bar": F.struct(part("feature", top), part("abs_shap_value", top)),
        }
    )
