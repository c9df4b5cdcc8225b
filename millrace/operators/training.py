"""Training, scoring and model selection on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.evaluation import accuracy, weighted_scores
from millrace.operators.scaling import with_class_weights
from millrace.operators.serving import decide
from millrace.operators.splits import stratified_folds
from millrace.session import materialize

# Depth limit of Spark trees, and split criteria by their usual names
# (log loss and entropy are the same criterion).
MAX_DEPTH = 30
CRITERIA = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}

# Distributed fits that a model selection keeps running at once.
PARALLEL_FITS = 4


def as_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    """Feature arrays as ML vectors."""
    return df.withColumn(features, array_to_vector(features))


def forest(
    n_estimators: int = 100,
    max_depth: int = 0,
    min_samples_leaf: int = 1,
    max_features_ratio: float | None = None,
    criterion: str = "gini",
    bootstrap: bool = True,
    seed: int = 42,
    label: str = "y",
    weight: str | None = None,
) -> RandomForestClassifier:
    """Random forest; depth 0 means as deep as Spark allows, a larger depth is an error."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"the depth is at most {MAX_DEPTH}")
    model = RandomForestClassifier(
        labelCol=label,
        numTrees=n_estimators,
        maxDepth=max_depth or MAX_DEPTH,
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=str(max_features_ratio) if max_features_ratio else "auto",
        impurity=CRITERIA[criterion],
        bootstrap=bootstrap,
        seed=seed,
    )
    return model.setWeightCol(weight) if weight else model


def boosted(n_estimators: int = 100, max_depth: int = 3, learning_rate: float = 0.1, seed: int = 42, label: str = "y") -> GBTClassifier:
    """Gradient boosting for two classes."""
    return GBTClassifier(labelCol=label, maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, seed=seed)


def logistic(max_iter: int = 1000, label: str = "y") -> LogisticRegression:
    return LogisticRegression(labelCol=label, maxIter=max_iter, family="multinomial")


def balanced(df: DataFrame, label: str = "y", weight: str = "weight") -> DataFrame:
    return with_class_weights(df, label, weight)


def fit(estimator, train: DataFrame) -> PipelineModel:
    return Pipeline(stages=[estimator]).fit(as_vectors(train))


def score(model, df: DataFrame, threshold: float | None = None, keep: Sequence[str] = ("id", "y")) -> DataFrame:
    """Predicted class and class probabilities. With a threshold the positive class is
    decided on its probability, otherwise the model's own prediction is used."""
    out = model.transform(as_vectors(df)).withColumn("probabilities", vector_to_array("probability"))
    predicted = decide(F.get("probabilities", 1), threshold) if threshold is not None else F.col("prediction").cast("int")
    return out.withColumn("pred", predicted).select(*keep, "pred", "probabilities")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importance_table(spark, model, names: Sequence[str]) -> DataFrame:
    """(feature, importance): the forest's own, or the mean absolute coefficient of a linear
    model. As long as the feature list."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(fitted, "featureImportances"):
        values = fitted.featureImportances.toArray()
    else:
        values = abs(fitted.coefficientMatrix.toArray()).mean(axis=0)
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    )


def top_importance(importance: DataFrame, k: int = 5) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def cross_validate(df: DataFrame, estimator, key: str = "id", label: str = "y", k: int = 5) -> DataFrame:
    """Accuracy of each of k stratified folds: every fold is scored by a model fitted on
    the others. The folds are a function of the key, so a retry sees the same folds. They are
    stored once; the distributed fits run side by side, and one row per fold is returned."""
    folded = materialize(stratified_folds(df, [key], label, k), "folds")

    def one(i: int) -> tuple[int, float | None]:
        model = fit(estimator, folded.where(F.col("fold") != i))
        scored = score(model, folded.where(F.col("fold") == i), keep=(key, label))
        return i, accuracy(scored, (), label).first()["accuracy"]

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        rows = list(pool.map(one, range(k)))
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population std over the folds."""
    return folds.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"), F.count("*").alias("folds"))


def _prefix_votes(trees: int, classes: int) -> Column:
    """Summed class probabilities of the first `trees` trees, from the per-tree array."""
    first = F.slice("per_tree", 1, trees)
    return F.array(*[F.aggregate(F.transform(first, lambda p: p[c]), F.lit(0.0), lambda acc, x: acc + x) for c in range(classes)])


def stage_sizes(n_estimators: int, epochs: int) -> list[int]:
    """Trees used at each step of the training curve."""
    base = max(1, n_estimators // epochs)
    return [min(e * base, n_estimators) for e in range(1, epochs + 1)]


def staged_metrics(forest_model, test: DataFrame, classes: Sequence[int], epochs: int = 5, key: str = "id", label: str = "y") -> DataFrame:
    """Accuracy and weighted F1 after each step of a training curve. The forest is fitted
    once; each step scores a prefix of its trees, all steps in one pass over the data."""
    fitted = forest_model.stages[-1] if isinstance(forest_model, PipelineModel) else forest_model
    rows = as_vectors(test).select(key, label, "features")
    for i, tree in enumerate(fitted.trees):
        one = tree.copy().setProbabilityCol(f"__p{i}").setRawPredictionCol("").setPredictionCol("")
        rows = one.transform(rows)
    per_tree = F.array(*[vector_to_array(f"__p{i}") for i in range(len(fitted.trees))])
    steps = [
        F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("trees"), _prefix_votes(n, fitted.numClasses).alias("votes"))
        for i, n in enumerate(stage_sizes(len(fitted.trees), epochs))
    ]
    staged = rows.select(key, label, per_tree.alias("per_tree")).select(key, label, F.inline(F.array(*steps)))
    scored = staged.withColumn("pred", F.array_position("votes", F.array_max("votes")) - 1)
    return weighted_scores(scored, classes, ["step", "trees"], label).select("step", "trees", "accuracy", "f1")


def boosted_curve(model, df: DataFrame, label: str = "y") -> DataFrame:
    """Loss after every boosting iteration of one fitted model, as (step, loss)."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = as_vectors(df).select(F.col(label).alias(fitted.getLabelCol()), "features")
    losses = fitted.evaluateEachIteration(rows)
    return df.sparkSession.createDataFrame([(i + 1, float(x)) for i, x in enumerate(losses)], "step int, loss double")


def run_trials(train: DataFrame, test: DataFrame, trials: Sequence[Mapping], label: str = "y") -> DataFrame:
    """Fit each assignment of a bounded trial list on shared data and score it: one row per
    trial with its parameters and metrics. Every fit is a distributed job, several run side by
    side; only the one metrics row of a trial reaches the driver."""
    spark = train.sparkSession
    train, test = train.persist(), test.persist()

    def one(number: int, params: Mapping) -> tuple:
        model = fit(forest(label=label, **params), train)
        metrics = weighted_scores(score(model, test, keep=(label,)), [0, 1], (), label).first()
        return number, json.dumps(dict(sorted(params.items()))), *metrics

    try:
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            rows = list(pool.map(one, range(len(trials)), trials))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "trial int, params string, accuracy double, precision double, recall double, f1 double")


def run_trial_table(train: DataFrame, test: DataFrame, trials: DataFrame, names: Sequence[str], trial: str = "trial", label: str = "y", most: int = 1000) -> DataFrame:
    """`run_trials` for a table of assignments (trial and one column per parameter): their rows go
    to the driver, which starts a fit for each, so there are `most` at most. Returns trial and metrics."""
    held = trials.select(trial, *names).orderBy(trial).limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} trials: each is a fit of its own")
    out = run_trials(train, test, [{n: r[n] for n in names} for r in held], label)
    ids = train.sparkSession.createDataFrame([(i, r[trial]) for i, r in enumerate(held)], f"number int, {trial} {trials.schema[trial].dataType.simpleString()}")
    return out.withColumnRenamed("trial", "number").join(ids, "number").select(trial, "accuracy", "precision", "recall", "f1")
