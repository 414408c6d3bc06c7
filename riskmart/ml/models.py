"""Classifier specifications, fitting, tuning, scoring and importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.numeric import class_probability
from riskmart.ml.selection import search

WEIGHT = "sample_weight"
RANDOM_FOREST, LOGISTIC, GBT = "random_forest", "logistic_regression", "gbt"

_CLASSES = {RANDOM_FOREST: RandomForestClassifier, LOGISTIC: LogisticRegression, GBT: GBTClassifier}

# The published defaults of the three classifiers.
DEFAULTS: dict[str, dict[str, Any]] = {
    RANDOM_FOREST: {
        "numTrees": 100, "maxDepth": 10, "maxBins": 32, "minInstancesPerNode": 1, "subsamplingRate": 1.0,
    },
    LOGISTIC: {"regParam": 0.0, "elasticNetParam": 0.0, "maxIter": 100},
    GBT: {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "maxBins": 32, "minInstancesPerNode": 1},
}

# The published search grids, twelve combinations each.
GRIDS: dict[str, dict[str, list]] = {
    RANDOM_FOREST: {
        "numTrees": [100, 150, 200], "maxDepth": [10, 15], "maxBins": [64], "subsamplingRate": [0.8],
        "minInstancesPerNode": [5, 10],
    },
    GBT: {
        "maxIter": [30, 50], "maxDepth": [4, 5, 6], "stepSize": [0.1], "maxBins": [64],
        "minInstancesPerNode": [5, 10],
    },
    LOGISTIC: {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.3, 0.5], "maxIter": [100, 150]},
}


@dataclass(frozen=True)
class ModelSpec:
    """What to fit: the kind, its parameters and, for tuning, the values to try."""

    kind: str
    params: Mapping[str, Any] = field(default_factory=dict)
    grid: Mapping[str, Sequence[Any]] = field(default_factory=dict)
    seed: int = 42

    def __post_init__(self) -> None:
        if self.kind not in _CLASSES:
            raise ValueError(f"unknown model kind {self.kind!r}, expected one of {sorted(_CLASSES)}")

    def settings(self) -> dict[str, Any]:
        return {**DEFAULTS[self.kind], **self.params}

    def estimator(self, weighted: bool = True):
        options = {"featuresCol": "features", "labelCol": "label", **self.settings()}
        if weighted:
            options["weightCol"] = WEIGHT
        if self.kind != LOGISTIC:
            options["seed"] = self.seed
        return _CLASSES[self.kind](**options)


def with_label(df: DataFrame, target: str) -> DataFrame:
    """The target as the double column that classifiers read."""
    return df.selectExpr("*", f"double(`{target}`) AS label")


def _stages(classifier, features: Sequence[str]) -> Pipeline:
    """Feature vectors (NaN kept), then the classifier."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[vectors, classifier])


def stable_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Same rows in the same partitions and order on every run, so that sampled trees repeat.

    One shuffle of the narrow training columns by a unique key; no global sort.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit(
    spec: ModelSpec,
    train: DataFrame,
    target: str,
    features: Sequence[str],
    weighted: bool = True,
    folds: int = 3,
    fold_col: str | None = None,
    parallelism: int = 4,
) -> PipelineModel:
    """Fit once, or pick the grid point with the best cross-validated exact ROC area and refit it.

    ``fold_col`` holds fold numbers from 0; without one, rows are dealt by a hash of their values.
    """
    classifier = spec.estimator(weighted)
    pipeline, train = _stages(classifier, features), with_label(train, target)
    if not spec.grid:
        return pipeline.fit(train)
    grid = ParamGridBuilder()
    for name, values in spec.grid.items():
        grid = grid.addGrid(classifier.getParam(name), list(values))
    if not fold_col:
        fold_col = "_fold"
        train = train.withColumn(fold_col, F.pmod(F.xxhash64(F.lit(spec.seed), *train.columns), F.lit(folds)).cast("int"))
    return search(pipeline, grid.build(), train, folds, fold_col, parallelism)[0]


def score(model: PipelineModel, df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """``label, prediction, score``: the score is the probability of class 1 (0.0 if there is none)."""
    return model.transform(with_label(df, target)).select(
        *keep,
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        class_probability("probability").alias("score"),
    )


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame | None:
    """``feature, importance`` of a tree model; None for a model without importances."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return None
    values = last.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")
