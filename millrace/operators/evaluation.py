"""Classification metrics from one grouped pass over the scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.prefix import prefix_sums, value_cuts, with_value_bucket
from millrace.functions.scalars import ratio
from millrace.session import materialize


def accuracy(df: DataFrame, keys: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def _only(classes: Sequence[int], y: str, pred: str, value: Column) -> Column:
    """The aggregate `value`, or an error where a row's class is not in the list."""
    listed = F.coalesce(F.col(y).isin(list(classes)) & F.col(pred).isin(list(classes)), F.lit(False))
    return F.when(F.count_if(~listed) == 0, value).otherwise(F.raise_error(F.lit(f"a class is not in the list {list(classes)}")).cast("long"))


def class_tallies(
    df: DataFrame, classes: Sequence[int], keys: Sequence[str] = (), y: str = "y", pred: str = "pred"
) -> DataFrame:
    """Per group: `total`, `correct` and one struct per class with true positives,
    support and number predicted. Rows of a class outside the list are an error."""
    aggs: list[Column] = [_only(classes, y, pred, F.count("*")).alias("total"), F.count_if(F.col(y) == F.col(pred)).alias("correct")]
    for i, c in enumerate(classes):
        aggs += [
            F.count_if((F.col(y) == c) & (F.col(pred) == c)).alias(f"__tp{i}"),
            F.count_if(F.col(y) == c).alias(f"__su{i}"),
            F.count_if(F.col(pred) == c).alias(f"__pr{i}"),
        ]

    def scores(i: int, label: int) -> Column:
        tp, support, predicted = (F.col(f"__{p}{i}").cast("double") for p in ("tp", "su", "pr"))
        return F.struct(
            F.lit(str(label)).alias("label"),
            ratio(tp, predicted).alias("precision"),
            ratio(tp, support).alias("recall"),
            ratio(2 * tp, predicted + support).alias("f1"),
            F.col(f"__su{i}").alias("support"),
        )

    return df.groupBy(*keys).agg(*aggs).select(
        *keys, "total", "correct", F.array(*[scores(i, c) for i, c in enumerate(classes)]).alias("per_class")
    )


def _mean(metric: str, weighted: bool) -> Column:
    weight = (lambda s: s["support"].cast("double")) if weighted else (lambda s: F.lit(1.0))
    top = F.aggregate("per_class", F.lit(0.0), lambda acc, s: acc + weight(s) * s[metric])
    return ratio(top, F.aggregate("per_class", F.lit(0.0), lambda acc, s: acc + weight(s)))


def weighted_scores(
    df: DataFrame, classes: Sequence[int], keys: Sequence[str] = (), y: str = "y", pred: str = "pred"
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 per group."""
    return class_tallies(df, classes, keys, y, pred).select(
        *keys,
        ratio(F.col("correct").cast("double"), F.col("total").cast("double")).alias("accuracy"),
        *[_mean(m, True).alias(m) for m in ("precision", "recall", "f1")],
    )


def class_report(
    df: DataFrame, classes: Sequence[int], keys: Sequence[str] = (), y: str = "y", pred: str = "pred"
) -> DataFrame:
    """One row per class, then the macro and weighted averages."""

    def average(label: str, weighted: bool) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            *[_mean(m, weighted).alias(m) for m in ("precision", "recall", "f1")],
            F.col("total").alias("support"),
        )

    rows = F.concat("per_class", F.array(average("macro avg", False), average("weighted avg", True)))
    return class_tallies(df, classes, keys, y, pred).select(*keys, F.inline_outer(rows))


def confusion_matrix(
    df: DataFrame, classes: Sequence[int], keys: Sequence[str] = (), y: str = "y", pred: str = "pred"
) -> DataFrame:
    """Count of every (actual, predicted) pair of the given classes, zeros included. Rows of a
    class outside the list are an error."""
    counts = df.groupBy(*keys, y, pred).agg(_only(classes, y, pred, F.count("*")).alias("__n"))
    pairs = [(a, b) for a in classes for b in classes]
    wide = counts.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when((F.col(y) == a) & (F.col(pred) == b), F.col("__n"))), F.lit(0)).alias(f"__c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"__c{i}").alias("n"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(*keys, F.inline_outer(cells))


def roc_auc(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", score: str = "p1", buckets: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve with ties averaged; 0 unless there are exactly the two
    classes 0 and 1.

    Rows are counted per distinct score, once, and the counts are stored; the cuts come from
    them, and the ordering runs over score buckets, so no group is sorted as a whole.
    """
    scored = df.select(*keys, y, F.col(score).cast("double").alias("__s"))
    per_score = scored.groupBy(*keys, "__s").agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"), F.count_if(~F.coalesce(F.col(y).isin(0, 1), F.lit(False))).alias("other")
    )
    per_score = materialize(per_score, "score-counts")
    placed = prefix_sums(
        with_value_bucket(per_score, "__s", value_cuts(per_score, "__s", buckets), "__bucket_of_score"),
        keys,
        [F.col("__s")],
        F.col("__bucket_of_score"),
        {"neg_run": F.col("neg")},
    )
    area = F.sum(F.col("pos").cast("double") * (F.col("neg_run_before") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return placed.groupBy(*keys).agg(F.when(F.sum("other") > 0, 0.0).otherwise(ratio(area, pairs)).alias("auc"))


def overfit_gap(df: DataFrame, split: str = "split", keys: Sequence[str] = (), y: str = "y", pred: str = "pred") -> DataFrame:
    """Accuracy on train, test and all rows, and train minus test."""
    hit = (F.col(y) == F.col(pred)).cast("double")
    return df.groupBy(*keys).agg(
        F.avg(F.when(F.col(split) == "train", hit)).alias("train_accuracy"),
        F.avg(F.when(F.col(split) == "test", hit)).alias("test_accuracy"),
        F.avg(hit).alias("full_accuracy"),
    ).withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy"))


def metric_records(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Report rows as (name, value, format) records named class_{label}_{metric}."""
    prefix = F.concat(F.lit("class_"), F.replace(F.col("label"), F.lit(" "), F.lit("_")), F.lit("_"))
    records = F.array(
        *[
            F.struct(F.concat(prefix, F.lit(m)).alias("name"), F.col(m).cast("double").alias("value"), F.lit(f).alias("format"))
            for m, f in (("precision", "PERCENTAGE"), ("recall", "PERCENTAGE"), ("f1", "PERCENTAGE"), ("support", "RAW"))
        ]
    )
    return report.select(*keys, F.inline_outer(records))
