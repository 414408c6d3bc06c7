"""Fit, tune, evaluate and compare models; every run is appended to the run table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskmart.ml import models
from riskmart.ml.models import ModelSpec
from riskmart.ml.stages import FeatureSteps, carried
from riskmart.operators import features, metrics, runs, split
from riskmart.operators.dedupe import union_all
from riskmart.sinks import writers
from riskmart.sources import readers, schemas
from riskmart.zones import Zones

METRICS = ("accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_pr")


def feature_frame(df: DataFrame, target: str = "is_terminated", include_boolean: bool = False) -> DataFrame:
    """Numeric flags, funding and log features, complete rows. The same stage serves train, test and saved models."""
    return FeatureSteps(target, includeBoolean=include_boolean).transform(df)


def fit_and_valid(df: DataFrame, key: str, target: str, train_ratio: float, seed: int, stratified: bool) -> DataFrame:
    """Training rows with the column ``part``: ``fit`` or ``valid``."""
    names = ("fit", "valid")
    if stratified:
        return split.stratified_split(df, key, target, train_ratio, seed, names, "part", "inner")
    return split.hash_split(df, key, train_ratio, seed, names, "part", "inner")


def summarize(predictions: DataFrame, prefix: str) -> dict[str, float | None]:
    """The six metrics of one model: two one-row aggregates, nothing else reaches the driver.

    The three narrow columns are persisted while they are measured, so the model scores once.
    """
    kept = predictions.select("label", "prediction", "score").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = metrics.binary_metrics(kept).first()
        curve = metrics.areas(kept).first()
    finally:
        kept.unpersist()
    values = {**counts.asDict(), **(curve.asDict() if curve else {})}
    return {f"{prefix}_{m}": values.get(m) for m in METRICS}


class Experiment:
    """One target, one feature list and a run table to append to.

    With ``steps`` the saved models begin with them: they score rows of the wide table, not of the feature frame.
    """

    def __init__(
        self,
        spark: SparkSession,
        zones: Zones,
        name: str,
        target: str = "is_terminated",
        features: Sequence[str] | None = None,
        key: str = "award_id",
        steps: FeatureSteps | None = None,
    ):
        self.spark, self.zones, self.name = spark, zones, name
        self.target, self.features, self.key = target, features, key
        self.steps = steps
        self.train: DataFrame | None = None
        self.test: DataFrame | None = None

    def load(self, train: DataFrame, test: DataFrame | None = None) -> "Experiment":
        self.train, self.test = train, test
        if self.features is None:
            self.features = features.feature_columns(train, self.target, drop=(self.key,))
        return self

    def fit(
        self,
        spec: ModelSpec,
        run_name: str,
        train_ratio: float = 0.8,
        seed: int = 42,
        folds: int = 3,
        parallelism: int = 4,
        partitions: int | None = None,
        stratified: bool = False,
    ) -> tuple[PipelineModel, dict[str, float | None]]:
        """Weight, split off a validation part, fit or tune, measure, log.

        The narrow training columns are laid out once by key and persisted (spilling to disk),
        as tuning reads them dozens of times; losing an executor only recomputes its blocks.
        ``stratified`` gives both parts the exact share of each class.
        """
        if self.train is None:
            raise ValueError("call load() before fit()")
        wanted = [self.key, self.target, *self.features]
        weighted = features.class_weights(self.train.select(wanted), self.target)
        parts = fit_and_valid(weighted, self.key, self.target, train_ratio, seed, stratified)
        fitting = split.hash_folds(parts.filter("part = 'fit'").drop("part"), self.key, folds, seed)
        n = partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        fitting = models.stable_layout(fitting, self.key, n).persist(StorageLevel.MEMORY_AND_DISK)
        started = datetime.now(timezone.utc)
        try:
            model = models.fit(
                spec, fitting, self.target, self.features, folds=folds, fold_col="fold", parallelism=parallelism
            )
        finally:
            fitting.unpersist()
        valid = models.score(model, parts.filter("part = 'valid'"), self.target)
        found = summarize(valid, "valid")
        self._log(run_name, started, model, found)
        return model, found

    def predict(self, model: PipelineModel, df: DataFrame | None = None) -> DataFrame:
        data = self.test if df is None else df
        if data is None:
            raise ValueError("no test data was loaded")
        return models.score(model, data.drop(models.WEIGHT), self.target, [c for c in (self.key,) if c in data.columns])

    def evaluate(self, model: PipelineModel) -> dict[str, float | None]:
        """Holdout metrics."""
        return summarize(self.predict(model), "test")

    def _log(self, run_name: str, started: datetime, model: PipelineModel, found: Mapping[str, float | None]) -> str:
        run_id = uuid.uuid4().hex
        last = model.stages[-1]
        params = {p.name: str(v) for p, v in last.extractParamMap().items()}
        values = {k: float(v) for k, v in found.items() if v is not None}
        stored = carried(model, self.steps, self.features) if self.steps else model
        writers.save_model(stored, f"{self.zones.models}/{run_id}")
        row = [(run_id, run_name, self.name, started, params, values, {})]
        writers.append_rows(self.spark.createDataFrame(row, schemas.RUN).coalesce(1), self.zones.runs)
        return run_id

    def history(self, names: Sequence[str] = ("valid_accuracy", "valid_f1_score", "valid_auc_roc")) -> DataFrame:
        return runs.run_history(readers.read_table(self.spark, self.zones.runs), names, self.name)

    def tagged_runs(self) -> DataFrame:
        """Runs with the winners by F1 and by accuracy tagged."""
        table = readers.read_table(self.spark, self.zones.runs).filter(F.col("experiment") == self.name)
        return runs.with_best_tags(table, {"best_f1": "valid_f1_score", "best_accuracy": "valid_accuracy"})


def stacked_predictions(experiment: Experiment, fitted: Mapping[str, PipelineModel], valid: DataFrame) -> DataFrame:
    """All models over validation and test in one long frame."""
    parts = {"valid": valid, "test": experiment.test}
    return union_all(
        [
            experiment.predict(model, data).withColumns({"model": F.lit(name), "split": F.lit(part)})
            for name, model in fitted.items()
            for part, data in parts.items()
        ]
    )


def evaluation_report(
    experiment: Experiment, fitted: Mapping[str, PipelineModel], valid: DataFrame
) -> dict[str, DataFrame]:
    """The tables behind every chart and listing of the model comparison.

    The stacked predictions are written once and read back: every table below starts from
    narrow columns on shared storage instead of scoring all models again.
    """
    path = f"{experiment.zones.predictions}/{experiment.name}"
    writers.replace_table(stacked_predictions(experiment, fitted, valid), path)
    predictions = readers.read_table(experiment.spark, path)
    test = predictions.filter("split = 'test'")
    report = {
        "comparison": metrics.model_comparison(predictions),
        "train_classes": features.class_distribution(experiment.train, experiment.target),
        "test_classes": features.class_distribution(experiment.test, experiment.target),
        "confusion": metrics.confusion_matrix(test, ["model"]),
        "roc": metrics.roc_points(test, ["model"]),
        "precision_recall": metrics.pr_points(test, ["model"]),
        "areas": metrics.areas(test, ["model"]),
    }
    for name, model in fitted.items():
        table = models.importances(model, experiment.features)
        if table is not None:
            report[f"importance_{name}"] = runs.topk_features(table)
    return report


def train_and_compare(
    spark: SparkSession,
    zones: Zones,
    name: str = "grants",
    specs: Mapping[str, ModelSpec] | None = None,
    target: str = "is_terminated",
    **options: Any,
) -> dict[str, DataFrame]:
    """Tune the three classifiers on the wide table, log them and write the comparison."""
    steps = FeatureSteps(target)
    train, test = (steps.transform(load(spark, zones)) for load in (readers.load_train, readers.load_test))
    experiment = Experiment(spark, zones, name, target, steps=steps).load(train, test)
    chosen = specs or {kind: ModelSpec(kind, grid=models.GRIDS[kind]) for kind in models.GRIDS}
    fitted = {label: experiment.fit(spec, label, **options)[0] for label, spec in chosen.items()}
    held_out = fit_and_valid(
        train, experiment.key, target, options.get("train_ratio", 0.8), options.get("seed", 42), options.get("stratified", False)
    ).filter("part = 'valid'")
    report = evaluation_report(experiment, fitted, held_out)
    writers.write_report(report["comparison"], f"{zones.reports}/{name}/comparison")
    return report
