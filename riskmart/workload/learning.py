"""Models over the labelled documents, at their published settings.

Fits on real features have no SQL twin: fitted weights are not SQL-expressible. On one 0/1 feature the
three classifiers have closed forms in the class-weighted shares of positives, and those are checked.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskmart.functions.text import word_count
from riskmart.ml import models
from riskmart.ml.models import ModelSpec
from riskmart.ml.stages import FeatureSteps, carried, predictions
from riskmart.operators import features, lexicon, metrics, runs, split
from riskmart.sinks import writers
from riskmart.sinks.scratch import run_folder
from riskmart.workload.registry import query
from riskmart.workload.standins import WORDS, titled_documents

TARGET = "is_terminated"
# Fitting runs hundreds of short jobs over the same narrow rows: their number of tasks follows the rows.
ROWS_PER_TASK = 20_000

def labelled(t):
    """Every labelled document with its text features, its label and its split."""
    made = lexicon.lexicon_features(titled_documents(t), WORDS)
    made = made.withColumn("n_words", word_count(F.col("abstract"))).drop("title", "abstract")
    joined = made.join(t.labels.withColumnRenamed("toxic", TARGET), "doc_id")
    numeric = features.bool_to_int(joined, ["has_flagged_words"])
    return split.hash_split(features.complete_cases(numeric), "doc_id")


def tasks_for(n_rows: int, most: int) -> int:
    return max(1, min(most, -(-n_rows // ROWS_PER_TASK)))


def _fit_and_score(t, kind):
    """Fit on the training part and score the rest.

    Fitting passes over its input many times, so the narrow numeric columns are persisted for
    its duration (a lost block is recomputed from the tables); scoring is one lazy pass.
    """
    data = labelled(t)
    names = features.feature_columns(data, TARGET, drop=("doc_id",))
    kept = data.persist(StorageLevel.MEMORY_AND_DISK)
    train = features.class_weights(kept.filter("split = 'train'"), TARGET)
    most = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = tasks_for(kept.count(), most)
    laid_out = models.stable_layout(train, "doc_id", partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = models.fit(ModelSpec(kind), laid_out, TARGET, names)
    finally:
        laid_out.unpersist()
        kept.unpersist()
    return model, names, models.score(model, labelled(t).filter("split = 'test'"), TARGET, ["doc_id"])


@query("ml_random_forest")
def ml_random_forest(t):
    return _fit_and_score(t, models.RANDOM_FOREST)[2]


@query("ml_logistic")
def ml_logistic(t):
    return _fit_and_score(t, models.LOGISTIC)[2]


@query("ml_gbt")
def ml_gbt(t):
    return _fit_and_score(t, models.GBT)[2]


@query("ml_score")
def ml_score(t):
    """Score distribution of the forest by label, in tenths."""
    scored = _fit_and_score(t, models.RANDOM_FOREST)[2]
    return scored.groupBy("label", F.floor(F.col("score") * 10).alias("tenth")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("ml_evaluate")
def ml_evaluate(t):
    """Holdout metrics of the logistic model."""
    scored = _fit_and_score(t, models.LOGISTIC)[2].withColumn("model", F.lit(models.LOGISTIC))
    return metrics.binary_metrics(scored, ["model"]).join(metrics.areas(scored, ["model"]), "model")


@query("ml_importance")
def ml_importance(t):
    model, names, _ = _fit_and_score(t, models.RANDOM_FOREST)
    return runs.topk_features(models.importances(model, names))


@query("ml_tuned")
def ml_tuned(t):
    """Best of a small grid by cross-validated ROC area: the chosen parameters and the holdout area."""
    data = labelled(t)
    names = features.feature_columns(data, TARGET, drop=("doc_id",))
    train = split.hash_folds(features.class_weights(data.filter("split = 'train'"), TARGET), "doc_id", 3, 42)
    spec = ModelSpec(models.LOGISTIC, grid={"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]})
    kept = models.stable_layout(train, "doc_id", int(t.spark.conf.get("spark.sql.shuffle.partitions"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = models.fit(spec, kept, TARGET, names, fold_col="fold")
    finally:
        kept.unpersist()
    scored = models.score(model, data.filter("split = 'test'"), TARGET, ["doc_id"])
    chosen = {p.name: float(v) for p, v in model.stages[-1].extractParamMap().items() if p.name in spec.grid}
    return metrics.auc_roc(scored).select(
        F.lit(chosen["regParam"]).alias("reg_param"), F.lit(chosen["elasticNetParam"]).alias("elastic_net_param"), "auc_roc"
    )


def returned_lines(t):
    """Lines with one 0/1 feature (heavily discounted) and a label (returned)."""
    return t.lineitem.selectExpr(
        "l_orderkey * 8 + l_linenumber AS line", "if(l_returnflag = 'R', 1, 0) AS is_terminated",
        "if(l_discount > 0.05, 1.0D, 0.0D) AS discounted",
    )


def _closed_form(score: str) -> str:
    """Score per feature value from ``s``, its class-weighted share of positives."""
    return f"""
    WITH l AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END::DOUBLE AS x
               FROM lineitem),
         n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS n1 FROM l),
         g AS (SELECT x, sum(y) * n / (2 * n1) AS pos, sum(1 - y) * n / (2 * (n - n1)) AS neg FROM l, n GROUP BY x, n, n1),
         s AS (SELECT x, pos / (pos + neg) AS s FROM g)
    SELECT x AS discounted, round({score}, 3) AS score FROM s"""


def _saturated(t, spec: ModelSpec):
    train = features.class_weights(returned_lines(t), TARGET)
    model = models.fit(spec, train, TARGET, ["discounted"])
    each = t.spark.range(2).selectExpr("double(id) AS discounted", "0 AS is_terminated")
    return models.score(model, each, TARGET, ["discounted"]).select("discounted", F.round("score", 3).alias("score"))


@query("ml_logistic_closed_form", _closed_form("s"))
def ml_logistic_closed_form(t):
    return _saturated(t, ModelSpec(models.LOGISTIC))


@query("ml_pipeline_closed_form", _closed_form("s"))
def ml_pipeline_closed_form(t):
    """A model saved with its feature steps, loaded again, scores the raw lines with their boolean columns."""
    raw = t.lineitem.selectExpr("l_returnflag = 'R' AS is_terminated", "l_discount > 0.05 AS discounted")
    steps = FeatureSteps(TARGET, ["discounted"])
    train = features.class_weights(steps.transform(raw), TARGET)
    fitted = models.fit(ModelSpec(models.LOGISTIC), train, TARGET, ["discounted"])
    path = f"{run_folder(t.spark)}/model-{uuid.uuid4().hex}"
    writers.save_model(carried(fitted, steps, ["discounted"]), path)
    scored = predictions(PipelineModel.load(path), raw, TARGET, ["discounted"])
    return scored.groupBy(F.col("discounted").cast("double").alias("discounted")).agg(F.round(F.max("score"), 3).alias("score"))


@query("ml_saved_pipeline")
def ml_saved_pipeline(t):
    """Raw labelled documents, flags still boolean, scored by a forest that carries its feature steps."""
    raw = lexicon.lexicon_features(titled_documents(t), WORDS).withColumn("n_words", word_count(F.col("abstract")))
    raw = raw.drop("title", "abstract").join(t.labels.withColumn(TARGET, F.col("toxic") == 1).drop("toxic"), "doc_id")
    steps = FeatureSteps(TARGET)
    prepared = split.hash_split(steps.transform(raw), "doc_id").filter("split = 'train'")
    names = features.feature_columns(prepared, TARGET, drop=("doc_id",))
    partitions = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    train = models.stable_layout(features.class_weights(prepared, TARGET), "doc_id", partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = models.fit(ModelSpec(models.RANDOM_FOREST, {"numTrees": 20, "maxDepth": 5}), train, TARGET, names)
    finally:
        train.unpersist()
    path = f"{run_folder(t.spark)}/model-{uuid.uuid4().hex}"
    writers.save_model(carried(fitted, steps, names), path)
    return predictions(PipelineModel.load(path), raw, TARGET, ["doc_id"])


@query("ml_tree_closed_form", _closed_form("s"))
def ml_tree_closed_form(t):
    """One tree of a forest that sees every row and every feature."""
    single = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    return _saturated(t, ModelSpec(models.RANDOM_FOREST, single))


@query("ml_boosting_closed_form", _closed_form("1 / (1 + exp(-2 * (2 * s - 1)))"))
def ml_boosting_closed_form(t):
    """The first step of boosting: a regression tree on labels -1 and 1."""
    return _saturated(t, ModelSpec(models.GBT, {"maxIter": 1}))
