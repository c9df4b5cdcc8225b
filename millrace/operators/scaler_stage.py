"""The scaler as a pipeline stage that ML persistence writes and reads again.

A fitted stage holds the feature names, the statistics that scale (mean, population std, min,
max), and the statistics of the scaled training columns (mean, sample std, min, max, median) that
checks of later requests are held against. All come from one wide aggregate and the exact
medians; they are as many numbers as features, whatever the size of the table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.quantiles import exact_quantiles
from millrace.operators.scaling import long_features, outliers, standardize

STATISTICS = ("mean", "std", "min", "max")
SCALED = ("mean", "std", "min", "max", "median")


class _HasFeatures(Params):
    features = Param(Params._dummy(), "features", "names of the scaled columns", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "ending of the names of scaled columns", TypeConverters.toString)


class TableScaler(Estimator, _HasFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the statistics of columns; nulls take no part."""

    @keyword_only
    def __init__(self, features: Sequence[str] = (), suffix: str = "_scaled"):
        super().__init__()
        self._setDefault(suffix="_scaled")
        self._set(**{k: list(v) if k == "features" else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> TableScalerModel:
        names = self.getOrDefault("features")
        kinds = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max, "n": F.count}
        wide = dataset.agg(*[F.struct(*[f(c).cast("double").alias(k) for k, f in kinds.items()]).alias(c) for c in names]).first()
        medians = exact_quantiles(long_features(dataset, names), ["feature"], "value", {"median": 0.5}).collect()  # a row per feature
        own = {c: {k: wide[c][k] for k in STATISTICS} for c in names}
        middle = {r["feature"]: r["median"] for r in medians}
        scaled = {c: _scaled_side(own[c], wide[c]["n"], middle.get(c)) for c in names}
        model = TableScalerModel(features=names, statistics=json.dumps({"own": own, "scaled": scaled}), suffix=self.getOrDefault("suffix"))
        return model._resetUid(self.uid) if hasattr(model, "_resetUid") else model


def _scaled_side(own: dict, n: float, median: float | None) -> dict:
    """Statistics of a column after scaling, which is a shift and a division: a zero std divides
    by one, so such a column is zero throughout."""
    if not n:
        return dict.fromkeys(SCALED)
    by = own["std"] or 1.0
    out = {k: (v - own["mean"]) / by for k, v in (("min", own["min"]), ("max", own["max"]), ("median", median))}
    return out | {"mean": 0.0, "std": own["std"] / by * math.sqrt(n / (n - 1)) if n > 1 else None}


class TableScalerModel(Model, _HasFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted scaler. Its statistics are parameters, so they are saved and read with the stage."""

    statistics = Param(Params._dummy(), "statistics", "statistics before and after scaling, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, features: Sequence[str] = (), statistics: str = "", suffix: str = "_scaled"):
        super().__init__()
        self._setDefault(suffix="_scaled")
        self._set(**{k: list(v) if k == "features" else v for k, v in self._input_kwargs.items()})

    def _rows(self, side: str, kinds: Sequence[str]) -> list[tuple]:
        held = json.loads(self.getOrDefault("statistics"))[side]
        return [(c, *(held[c][k] for k in kinds)) for c in self.getOrDefault("features")]

    def table(self, spark: SparkSession) -> DataFrame:
        """feature, mean, std, min, max: what the scaling operators read."""
        return spark.createDataFrame(self._rows("own", STATISTICS), "feature string, " + ", ".join(f"{k} double" for k in STATISTICS))

    def scaled_table(self, spark: SparkSession) -> DataFrame:
        """feature, mean, std, min, max, median of the training columns after scaling."""
        return spark.createDataFrame(self._rows("scaled", SCALED), "feature string, " + ", ".join(f"{k} double" for k in SCALED))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return standardize(dataset, self.getOrDefault("features"), self.table(dataset.sparkSession), self.getOrDefault("suffix"))

    def outliers(self, dataset: DataFrame, threshold: float = 5.0) -> DataFrame:
        return outliers(dataset, self.getOrDefault("features"), self.table(dataset.sparkSession), threshold)


def save_scaler(train: DataFrame, features: Sequence[str], path: str) -> str:
    """Fit the scaler as a pipeline of one stage and save it."""
    Pipeline(stages=[TableScaler(features=list(features))]).fit(train).write().overwrite().save(path)
    return path


def load_scaler(path: str) -> TableScalerModel:
    return PipelineModel.load(path).stages[0]
