"""Exact areas choose the model; curves keep the points that a plot needs."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from frames import rows
from riskmart.ml import models, selection
from riskmart.ml.models import ModelSpec
from riskmart.ml.selection import ExactArea
from riskmart.operators import metrics


def area_by_hand(data):
    pos = [s for l, s in data if l == 1]
    neg = [s for l, s in data if l != 1]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_exact_area_by_hand(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 1), rng.choice([0.1, 0.2, rng.random()])) for _ in range(300)]
    df = spark.createDataFrame([(l, s, Vectors.dense([1 - s, s])) for l, s in data], ["label", "score", "probability"])
    want = area_by_hand(data)
    assert ExactArea(scoreCol="score").evaluate(df) == pytest.approx(want, abs=1e-12)
    assert ExactArea().evaluate(df) == pytest.approx(want, abs=1e-12)
    assert ExactArea(scoreCol="score", metricName=selection.PR).evaluate(df) == pytest.approx(metrics.auc_pr(df).first()["auc_pr"])
    assert ExactArea(scoreCol="score").evaluate(df.filter("label = 1")) == 0.0
    with pytest.raises(ValueError):
        ExactArea(metricName="accuracy")


def close_models(bins=20, size=200):
    """Two models: 1 separates distant rows a little better, 0 also ranks rows that are close, where bins are blind."""
    out = []
    for point, low, high in ((0, 0.22, 0.78), (1, 0.2, 0.8)):
        for b in range(bins):
            positives = round(size * (low + (high - low) * b / (bins - 1)))
            for j in range(size):
                label = int(j >= size - positives if point == 0 else j < positives)
                out.append((point, label, b * size + j))
    return out


def test_bins_and_exact_areas_choose_differently(spark):
    data = close_models()
    frames = {p: spark.createDataFrame([(l, float(s)) for q, l, s in data if q == p], "label int, score double").coalesce(1) for p in (0, 1)}
    exact = {p: ExactArea(scoreCol="score").evaluate(f) for p, f in frames.items()}
    for p in frames:
        assert exact[p] == pytest.approx(area_by_hand([(l, s) for q, l, s in data if q == p]), abs=1e-12)
    few_bins = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=20)
    binned = {p: few_bins.evaluate(f) for p, f in frames.items()}
    assert exact[0] > exact[1] and binned[0] < binned[1]
    stacked = spark.createDataFrame([(p, fold, l, float(s)) for fold in range(3) for p, l, s in data], "point int, fold int, label int, score double")
    assert selection.best_point(stacked).first()["point"] == 0


def test_fold_areas(spark):
    rng = random.Random(2)
    data = [(p, f, rng.randint(0, 1), rng.choice([0.5, rng.random()])) for p in range(3) for f in range(2) for _ in range(80)]
    data += [(0, 2, 1, 0.3), (3, 0, 1, 0.1)]  # a fold and a point without negatives
    df = spark.createDataFrame(data, "point int, fold int, label int, score double")
    got = {r["point"]: (r["n_folds"], r["area"]) for r in selection.fold_areas(df, buckets=7).collect()}
    for p in range(3):
        want = sum(area_by_hand([(l, s) for q, f, l, s in data if (q, f) == (p, fold)]) for fold in range(2)) / 2
        assert got[p][0] == 2 and got[p][1] == pytest.approx(want, abs=1e-12)
    assert got[3] == (0, None)
    tied = df.filter("point = 1").unionByName(df.filter("point = 1").withColumn("point", F.lit(0)))
    assert selection.best_point(tied).first()["point"] == 0
    assert selection.best_point(df.limit(0)).count() == 0


def test_search_refits_the_best_point(spark):
    rng = random.Random(3)
    rows_ = []
    for i in range(600):
        x, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        rows_.append((i, int(x + 0.7 * rng.gauss(0, 1) > 0), x, noise, i % 3))
    df = spark.createDataFrame(rows_, "id int, y int, x double, noise double, fold int").withColumn(models.WEIGHT, F.lit(1.0)).cache()
    spec = ModelSpec(models.LOGISTIC, grid={"regParam": [100.0, 0.01], "elasticNetParam": [1.0]})
    model = models.fit(spec, df, "y", ["x", "noise"], folds=3, fold_col="fold")
    assert model.stages[-1].getOrDefault("regParam") == 0.01  # the other point knows no feature: area one half
    no_column = models.fit(spec, df.drop("fold"), "y", ["x", "noise"], folds=3)
    assert no_column.stages[-1].getOrDefault("regParam") == 0.01


def thinned_by_hand(data, thin):
    scores = sorted({s for _, s in data}, reverse=True)
    steps = [(sum(l == 1 for l, x in data if x == s), sum(l != 1 for l, x in data if x == s)) for s in scores]
    n_pos, n_neg = sum(p for p, _ in steps), sum(n for _, n in steps)
    out, tp, fp = [(None, 0.0, 0.0)], 0, 0
    for i, (s, (p, n)) in enumerate(zip(scores, steps)):
        tp, fp = tp + p, fp + n
        if 0 < i < len(steps) - 1:
            q, m = steps[i + 1]
            if (p, n) == (q, m) if thin == "equal_steps" else p * m == n * q:
                continue
        out.append((s, fp / n_neg, tp / n_pos))
    return sorted(out, key=repr)


@pytest.mark.parametrize("thin", ["equal_steps", "collinear"])
@pytest.mark.parametrize("buckets", [2, 3, 40, 512])
def test_thinned_points_by_hand(spark, thin, buckets):
    """Few scores and many, so that runs of equal steps begin, end and go on at the borders of buckets."""
    rng = random.Random(buckets)
    for size, kinds in ((3, 3), (60, 60), (300, 40), (400, 400)):
        data = [(0, 0.0), (1, 1.0)] + [(int(rng.random() < 0.8), rng.randint(0, kinds) / kinds) for _ in range(size)]
        df = spark.createDataFrame(data, "label int, score double")
        got = metrics.roc_points(df, buckets=buckets, thin=thin)
        assert rows(got, "threshold", "fpr", "tpr") == thinned_by_hand(data, thin)


def test_thinning_keeps_the_area(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(g, rng.randint(0, 1), round(rng.random(), 2)) for g in "ab" for _ in range(3_000)], "g string, label int, score double")
    whole, thin = (metrics.roc_points(df, ["g"], thin=t) for t in (None, "collinear"))
    assert thin.count() <= whole.count()
    for g in "ab":
        areas = []
        for points in (whole, thin):
            at = sorted((r["fpr"], r["tpr"]) for r in points.filter(F.col("g") == g).collect())
            areas.append(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(at, at[1:])))
        assert areas[0] == pytest.approx(areas[1], abs=1e-12)
    with pytest.raises(ValueError):
        metrics.roc_points(df, ["g"], thin="often")


def test_fits_use_no_more_tasks_than_rows_need():
    from riskmart.workload import learning

    assert [learning.tasks_for(n, 200) for n in (0, 1, 20_000, 20_001, 1_200_000, 10**9)] == [1, 1, 1, 2, 60, 200]
