"""Binary classification metrics and exact curves over prediction tables.

Predictions are a long frame: any non-null grouping columns (model, split ...), ``label`` 0/1,
``prediction`` 0/1 and ``score`` (higher = more positive).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.functions.numeric import ratio_or_null, ratio_or_zero


def _confusion_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1
    score = F.col("score").cast("double") if "score" in df.columns else F.lit(0.0)
    return df.groupBy(*by).agg(
        F.count_if(score.isNull() | F.isnan(score)).alias("n_unscored"),
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )


def binary_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1 (0 where undefined), in one pass.

    ``n_unscored`` rows have a prediction but no score (null or NaN): they count here and are in no
    curve or area.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _confusion_counts(df, by).select(
        *by,
        "tp", "fp", "fn", "tn",
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "n_unscored",
    )


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All four cells per group, empty ones included."""
    return _confusion_counts(df, by).selectExpr(
        *by, "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, prediction, n_rows)"
    )


def score_curve(df: DataFrame, by: Sequence[str] = (), buckets: int = 512, neighbours: bool = False) -> DataFrame:
    """Per distinct score: its positives and negatives, and those at or above it.

    Columns ``score, pos, neg, tp, fp, n_pos, n_neg``. A running sum over all scores would be a
    one-task window, so it is taken in two steps: within score buckets (parallel), on top of
    the totals of the higher buckets (one row per bucket). Equal scores are merged before the
    shuffle, so one score shared by a third of the rows is one row. The bucket bounds are
    quantiles of the scores, read to the driver as ``buckets`` numbers; they balance the work
    and do not affect the result. With ``neighbours`` each row also has the positives and negatives of
    the next lower score, ``next_pos`` and ``next_neg`` (null on the last one): a bucket's last score gets
    them from the first score of the next bucket that has any.
    """
    scored = df.select(*by, "label", F.col("score").cast("double").alias("score")).filter(
        "score IS NOT NULL AND NOT isnan(score)"
    )
    shares = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(scored.approxQuantile("score", shares, 0.5 / buckets))) or [0.0]  # none of an empty table
    bucketer = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="score", outputCol="_bucket")
    groups = scored.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    bucketed = bucketer.transform(groups).withColumn("_bucket", F.col("_bucket").cast("int"))
    higher = Window.partitionBy(*by).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = (
        bucketed.groupBy(*by, "_bucket")
        .agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.max_by(F.struct("pos", "neg"), "score").alias("_first"))
        .select(
            *by,
            "_bucket",
            F.coalesce(F.sum("_pos").over(higher), F.lit(0)).alias("_tp"),
            F.coalesce(F.sum("_neg").over(higher), F.lit(0)).alias("_fp"),
            F.sum("_pos").over(whole).alias("n_pos"),
            F.sum("_neg").over(whole).alias("n_neg"),
            *([F.lead("_first").over(Window.partitionBy(*by).orderBy(F.col("_bucket").desc())).alias("_next")] if neighbours else []),
        )
    )
    downwards = Window.partitionBy(*by, "_bucket").orderBy(F.col("score").desc())
    inside = downwards.rowsBetween(Window.unboundedPreceding, 0)
    beside = [
        F.coalesce(F.lead(c).over(downwards), F.col(f"_next.{c}")).alias(f"next_{c}") for c in ("pos", "neg") if neighbours
    ]
    # Building the hash side from the few offsets keeps the scores partitioned by bucket, which
    # is what the window below needs: the join and the window share one shuffle. Every bucket has
    # its offset; the join is an outer one only so that no null filter is pushed below the
    # grouping of one branch, which would keep the two branches from sharing its shuffle.
    return bucketed.join(offsets.hint("shuffle_hash"), [*by, "_bucket"], "left").select(
        *by,
        "score",
        "pos",
        "neg",
        (F.col("_tp") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_fp") + F.sum("neg").over(inside)).alias("fp"),
        "n_pos",
        "n_neg",
        *beside,
    )


def _precision(tp: Column, fp: Column) -> Column:
    return ratio_or_null(tp, tp + fp)


def _roc_area() -> Column:
    """Each negative counts the positives above it, and half of those tied with it."""
    ranked = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return ratio_or_null(ranked, F.max("n_pos").cast("double") * F.max("n_neg"))


def _pr_area(first_precision: Column | None) -> Column:
    """Trapezoids between consecutive thresholds; the point before a threshold is the threshold
    without its own rows, so no neighbour has to be looked up."""
    here = _precision(F.col("tp"), F.col("fp"))
    before = _precision(F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg"))
    start = here if first_precision is None else first_precision
    both = F.max("n_pos") * F.max("n_neg") > 0
    area = F.sum(ratio_or_null(F.col("pos"), F.col("n_pos")) * (here + F.coalesce(before, start)) / 2.0)
    return F.when(both, area)


def areas(df: DataFrame, by: Sequence[str] = (), buckets: int = 512) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve; null for a single class.

    ``auc_pr`` starts at the precision of the first threshold, ``auc_pr_from_one`` at 1.
    """
    return score_curve(df, by, buckets).groupBy(*by).agg(
        _roc_area().alias("auc_roc"),
        _pr_area(None).alias("auc_pr"),
        _pr_area(F.lit(1.0)).alias("auc_pr_from_one"),
    )


def auc_roc(df: DataFrame, by: Sequence[str] = (), buckets: int = 512) -> DataFrame:
    return areas(df, by, buckets).select(*by, "auc_roc")


def auc_pr(df: DataFrame, by: Sequence[str] = (), buckets: int = 512) -> DataFrame:
    return areas(df, by, buckets).select(*by, "auc_pr")


def _anchored(points: DataFrame, df: DataFrame, by: Sequence[str], anchor: dict[str, float]) -> DataFrame:
    start = df.select(*by).distinct() if by else df.agg(F.count(F.lit(1)).alias("_n"))
    first = start.select(*by, *[F.lit(v).cast("double").alias(k) for k, v in anchor.items()])
    return points.unionByName(first, allowMissingColumns=True)


def roc_points(df: DataFrame, by: Sequence[str] = (), buckets: int = 512, thin: str | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score, plus the origin (null threshold).

    ``thin`` leaves out points that the curve does not need, never the highest or lowest score:
    ``"equal_steps"`` those whose step from the point before equals the step to the next (what plotting
    libraries drop), ``"collinear"`` all that lie on the straight line between their neighbours.
    """
    if thin not in (None, "equal_steps", "collinear"):
        raise ValueError(f"unknown way to thin a curve: {thin!r}")
    curve = score_curve(df, by, buckets, neighbours=thin is not None)
    if thin:
        pos, neg, next_pos, next_neg = (F.col(c) for c in ("pos", "neg", "next_pos", "next_neg"))
        same = (pos == next_pos) & (neg == next_neg) if thin == "equal_steps" else pos * next_neg == neg * next_pos
        first = (F.col("tp") == pos) & (F.col("fp") == neg)
        curve = curve.filter(first | ~F.coalesce(same, F.lit(False)))
    points = curve.select(
        *by,
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio_or_null(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    return _anchored(points, df, by, {"fpr": 0.0, "tpr": 0.0})


def pr_points(df: DataFrame, by: Sequence[str] = (), buckets: int = 512) -> DataFrame:
    """``(threshold, precision, recall)`` for every distinct score, plus (1, 0)."""
    points = score_curve(df, by, buckets).select(
        *by,
        F.col("score").alias("threshold"),
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        ratio_or_null(F.col("tp"), F.col("n_pos")).alias("recall"),
    )
    return _anchored(points, df, by, {"precision": 1.0, "recall": 0.0})


def model_comparison(df: DataFrame, buckets: int = 512) -> DataFrame:
    """One row per model: validation accuracy, F1 and AUC beside the test metrics, best test AUC first.

    Input has the columns ``model`` and ``split`` (``valid`` / ``test``). The ranking window
    sees one row per model.
    """
    by = ["model", "split"]
    scored = binary_metrics(df, by).join(areas(df, by, buckets), by)

    def on(split: str, metric: str, out: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric))).alias(out)

    per_model = scored.groupBy("model").agg(
        on("valid", "accuracy", "val_accuracy"),
        on("valid", "f1_score", "val_f1"),
        on("valid", "auc_roc", "val_auc_roc"),
        on("test", "accuracy", "test_accuracy"),
        on("test", "precision", "test_precision"),
        on("test", "recall", "test_recall"),
        on("test", "f1_score", "test_f1"),
        on("test", "auc_roc", "test_auc_roc"),
        on("valid", "n_unscored", "val_unscored"),
        on("test", "n_unscored", "test_unscored"),
    )
    return per_model.withColumn(
        "position", F.rank().over(Window.orderBy(F.col("test_auc_roc").desc_nulls_last(), "model"))
    )
