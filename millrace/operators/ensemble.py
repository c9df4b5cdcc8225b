"""Combining the predictions of several models for one instance.

The operators read one row per instance with
`votes: array<struct<model, prediction, probabilities: array<double>>>`, so combining
needs no shuffle. `votes_from_rows` builds that column from a table with one row per
instance and model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import literal_map


def votes_from_rows(
    rows: DataFrame,
    instance: str,
    models: Sequence[str],
    model: str = "model",
    prediction: str = "prediction",
    probabilities: str = "probabilities",
) -> DataFrame:
    """One row per instance. Each model fills one slot, so a group is never larger than
    the model list and the partial aggregate merges before the shuffle. A model that is not in
    the list is an error, not a lost vote."""
    known = F.coalesce(F.col(model).isin(list(models)), F.lit(False))
    unknown = F.raise_error(F.concat(F.lit("model not in the list: "), F.coalesce(F.col(model).cast("string"), F.lit("null"))))
    rows = rows.where(F.when(known, F.lit(True)).otherwise(unknown.cast("boolean")))

    def slot(name: str) -> Column:
        vote = F.struct(
            F.lit(name).alias("model"), F.col(prediction).alias("prediction"), F.col(probabilities).alias("probabilities")
        )
        return F.max_by(F.when(F.col(model) == name, vote), F.when(F.col(model) == name, F.lit(1)))

    packed = rows.groupBy(instance).agg(*[slot(m).alias(f"__v{i}") for i, m in enumerate(models)])
    return packed.select(
        instance, F.filter(F.array(*[f"__v{i}" for i in range(len(models))]), lambda v: v.isNotNull()).alias("votes")
    )


def majority_vote(df: DataFrame, votes: str = "votes") -> DataFrame:
    """Most frequent class and its share of the votes; the smallest class wins a tie."""
    preds = F.transform(votes, lambda v: v["prediction"])
    best = F.array_max(
        F.transform(
            F.array_distinct(preds),
            lambda c: F.struct(F.size(F.filter(preds, lambda p: p == c)).alias("n"), (-c).alias("neg")),
        )
    )
    return df.withColumn("__best", best).withColumns(
        {
            "prediction": -F.col("__best.neg"),
            "confidence": F.try_divide(F.col("__best.n").cast("double"), F.size(votes).cast("double")),
        }
    ).drop("__best")


def _class_probability(vote: Column, cls: Column) -> Column:
    """Stored probability, or the one-hot form of the prediction when none is stored."""
    return F.coalesce(F.get(vote["probabilities"], cls), F.when(vote["prediction"] == cls, 1.0).otherwise(0.0))


def weighted_average(
    df: DataFrame, weights: Mapping[str, float], classes: int | None = None, votes: str = "votes", tolerance: float = 1e-9
) -> DataFrame:
    """Weighted mean probability over the models present (weight 1 when none is given)
    and the first class with the largest mean. Means closer than `tolerance` are equal, so
    that the order of summation cannot decide a tie. The number of classes is that of the
    longest probability array or the largest predicted class, unless given."""
    table = literal_map(weights)
    model_weights = F.transform(votes, lambda v: F.coalesce(F.try_element_at(table, v["model"]), F.lit(1.0)))

    def add(acc: Column, x: Column) -> Column:
        return acc + x

    width = F.greatest(
        F.lit(1),
        F.coalesce(F.array_max(F.transform(votes, lambda v: F.size(v["probabilities"]))), F.lit(1)),
        F.coalesce(F.array_max(F.transform(votes, lambda v: v["prediction"].cast("int"))) + 1, F.lit(1)),
    )

    def mean(cls: Column) -> Column:
        parts = F.zip_with("__weights", votes, lambda w, v: w * _class_probability(v, cls))
        return F.try_divide(F.aggregate(parts, F.lit(0.0), add), F.col("__total"))

    out = df.withColumn("__weights", model_weights).withColumn("__total", F.aggregate("__weights", F.lit(0.0), add))
    if classes is None:
        means = F.transform(F.sequence(F.lit(0), width - 1), mean)
    else:
        means = F.array(*[mean(F.lit(c)) for c in range(classes)])
    out = out.withColumn("mean_probabilities", means)
    if classes is None:
        near_top = F.transform("mean_probabilities", lambda p: p >= F.array_max("mean_probabilities") - tolerance)
        best = (F.array_position(near_top, True) - 1).cast("int")
    else:
        top = F.greatest(*[F.get("mean_probabilities", F.lit(c)) for c in range(classes)], F.lit(float("-inf")))
        best = F.coalesce(*[F.when(F.get("mean_probabilities", F.lit(c)) >= top - tolerance, c) for c in range(classes)])
    out = out.withColumn("prediction", best)
    return out.withColumn("confidence", F.get("mean_probabilities", F.col("prediction"))).drop("__weights", "__total")


def max_confidence(df: DataFrame, votes: str = "votes", digits: int = 9) -> DataFrame:
    """The vote of the most confident model; the first model wins a tie."""
    ranked = F.transform(
        votes,
        lambda v, i: F.struct(
            F.round(F.coalesce(F.array_max(v["probabilities"]), F.lit(0.5)), digits).alias("confidence"),
            (-i).alias("neg"),
            v["model"].alias("model"),
            v["prediction"].alias("prediction"),
        ),
    )
    return df.withColumn("__best", F.array_max(ranked)).withColumns(
        {
            "prediction": F.col("__best.prediction"),
            "confidence": F.col("__best.confidence"),
            "selected_model": F.col("__best.model"),
        }
    ).drop("__best")


def combine(df: DataFrame, method: str, weights: Mapping[str, float] | None = None, votes: str = "votes", classes: int | None = None) -> DataFrame:
    """Dispatch by method name, with the aggregation record (method, models) attached. An
    instance without any vote is an error. A number of classes that is known saves looking for
    it in every row."""
    some = F.raise_error(F.lit("no predictions to combine")).cast("boolean")
    df = df.where(F.when(F.size(votes) > 0, F.lit(True)).otherwise(some))
    if method == "majority_vote":
        out = majority_vote(df, votes)
    elif method == "weighted_average":
        out = weighted_average(df, weights or {"": 1.0}, classes, votes)
    elif method == "max_confidence":
        out = max_confidence(df, votes)
    else:
        raise ValueError(f"unknown aggregation method: {method}")
    return out.withColumns(
        {
            "method": F.lit(method),
            "num_models": F.size(votes),
            "models": F.transform(votes, lambda v: v["model"]),
        }
    )
