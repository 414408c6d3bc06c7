"""Choosing a model by the exact area under a curve.

The library's binary evaluator cuts the curve into a fixed number of bins; rows within a bin count as tied. Models that
are close to one another are then told apart by where the cuts fall. Here areas are exact. In a search the held-out
scores of all folds and grid points are written as one table, and one job measures all of them: every (point, fold) is a
group of the curve, whose running sums are made in score buckets, so that the number of rows of a fold is no limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskmart.functions.numeric import class_probability
from riskmart.operators import metrics
from riskmart.operators.dedupe import union_all
from riskmart.sinks.scratch import written

ROC, PR = "areaUnderROC", "areaUnderPR"
_AREA = {ROC: "auc_roc", PR: "auc_pr"}


class ExactArea(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Exact area under the ROC or precision-recall curve; 0 where a class is missing.

    For the library's own searches. ``scoreCol`` is a number or a probability vector, whose class 1 is taken.
    """

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "score or probability column", TypeConverters.toString)
    metricName = Param(Params._dummy(), "metricName", f"{ROC} or {PR}", TypeConverters.toString)

    def __init__(self, labelCol: str = "label", scoreCol: str = "probability", metricName: str = ROC):
        super().__init__()
        self._setDefault(labelCol="label", scoreCol="probability", metricName=ROC)
        if metricName not in _AREA:
            raise ValueError(f"unknown metric {metricName!r}, expected one of {sorted(_AREA)}")
        self._set(labelCol=labelCol, scoreCol=scoreCol, metricName=metricName)

    def _evaluate(self, dataset: DataFrame) -> float:
        score = self.getOrDefault("scoreCol")
        value = F.col(score) if dict(dataset.dtypes)[score] != "vector" else class_probability(score)
        scored = dataset.select(F.col(self.getOrDefault("labelCol")).cast("int").alias("label"), value.alias("score"))
        found = metrics.areas(scored).first()
        return float(found[_AREA[self.getOrDefault("metricName")]] or 0.0) if found else 0.0

    def isLargerBetter(self) -> bool:
        return True


def fold_areas(scores: DataFrame, metric: str = ROC, buckets: int = 512) -> DataFrame:
    """(point, n_folds, area): mean exact area of each grid point over the folds where both classes occur.

    ``scores`` has the columns ``point, fold, label, score``.
    """
    measured = metrics.areas(scores, ["point", "fold"], buckets)
    return measured.groupBy("point").agg(F.count(_AREA[metric]).alias("n_folds"), F.avg(_AREA[metric]).alias("area"))


def best_point(scores: DataFrame, metric: str = ROC, buckets: int = 512) -> DataFrame:
    """The one row of :func:`fold_areas` with the largest area; ties go to the first grid point."""
    return fold_areas(scores, metric, buckets).filter("area IS NOT NULL").orderBy(F.desc("area"), "point").limit(1)


def search(
    pipeline: Pipeline, points: Sequence[dict], train: DataFrame, folds: int, fold_col: str, parallelism: int = 4, metric: str = ROC
) -> tuple[PipelineModel, int]:
    """Refit the grid point with the best mean area over the folds; also returns which one it was.

    Fits run side by side, each over the other folds. No score is measured by itself: the held-out scores of all
    ``len(points) * folds`` models go to one table.
    """
    def held_out(task: tuple[int, int]) -> DataFrame:
        point, fold = task
        fitted = pipeline.fit(train.filter(F.col(fold_col) != fold), points[point])
        scored = fitted.transform(train.filter(F.col(fold_col) == fold))
        return scored.select(
            F.lit(point).alias("point"), F.lit(fold).alias("fold"), F.col("label").cast("int").alias("label"),
            class_probability("probability").alias("score"),
        )

    tasks = [(point, fold) for point in range(len(points)) for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(inheritable_thread_target(train.sparkSession)(held_out), tasks))
    found = best_point(written(union_all(parts), "fold-scores"), metric).collect()
    chosen = found[0]["point"] if found else 0
    return pipeline.fit(train, points[chosen]), chosen
