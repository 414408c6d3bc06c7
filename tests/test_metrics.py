from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from frames import rows
from riskmart.operators import metrics, runs

# Published results of three models and the smallest confusion counts that reproduce them.
PUBLISHED = {
    "rf": ((6, 90, 20, 1441), (0.9294, 0.0625, 0.2308, 0.0984)),
    "gbt": ((11, 170, 15, 1361), (0.8812, 0.0608, 0.4231, 0.1063)),
    "lr": ((7, 162, 19, 1369), (0.8838, 0.0414, 0.2692, 0.0718)),
}


def test_published_metrics(spark):
    data = []
    for model, ((tp, fp, fn, tn), _) in PUBLISHED.items():
        data += [(model, 1, 1)] * tp + [(model, 0, 1)] * fp + [(model, 1, 0)] * fn + [(model, 0, 0)] * tn
    df = spark.createDataFrame(data, "model string, label int, prediction int")
    for r in metrics.binary_metrics(df, ["model"]).collect():
        counts, values = PUBLISHED[r["model"]]
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == counts
        assert tuple(round(r[n], 4) for n in ("accuracy", "precision", "recall", "f1_score")) == values
    cells = metrics.confusion_matrix(df.filter("model = 'rf'"))
    assert rows(cells) == [(0, 0, 1441), (0, 1, 90), (1, 0, 20), (1, 1, 6)]


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert tuple(metrics.binary_metrics(df).first()) == (0, 0, 1, 1, 0.5, 0.0, 0.0, 0.0, 0)
    unscored = spark.createDataFrame([(1, 1, None), (0, 0, float("nan")), (1, 1, 0.5)], "label int, prediction int, score double")
    assert metrics.binary_metrics(unscored).first()["n_unscored"] == 2
    assert rows(metrics.confusion_matrix(df)) == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]


def brute(data):
    """Areas by definition: pair counting, and trapezoids between thresholds."""
    pos = [s for l, s in data if l == 1]
    neg = [s for l, s in data if l == 0]
    if not pos or not neg:
        return None, None, None
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    points = []
    for cut in sorted({s for _, s in data}, reverse=True):
        tp, fp = sum(s >= cut for s in pos), sum(s >= cut for s in neg)
        points.append((tp / len(pos), tp / (tp + fp)))

    def area(first):
        last, total = (0.0, first), 0.0
        for r, p in points:
            total += (r - last[0]) * (p + last[1]) / 2
            last = (r, p)
        return total

    return roc, area(points[0][1]), area(1.0)


@pytest.mark.parametrize("seed, distinct", [(1, 3), (2, 40), (3, 10_000)])
def test_areas_against_brute_force_and_evaluator(spark, seed, distinct):
    """A third of all rows shares one score."""
    rng = random.Random(seed)
    data = [
        (int(rng.random() < 0.3), 0.5 if rng.random() < 0.34 else rng.randrange(distinct) / distinct) for _ in range(700)
    ]
    df = spark.createDataFrame(data, "label int, score double")
    expected = brute(data)
    for buckets in (2, 7, 512):
        got = metrics.areas(df.repartition(3), buckets=buckets).first()
        assert tuple(got) == pytest.approx(expected, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    labelled = df.withColumn("label", F.col("label").cast("double"))
    assert evaluator.evaluate(labelled, {evaluator.metricName: "areaUnderROC"}) == pytest.approx(expected[0])
    assert evaluator.evaluate(labelled, {evaluator.metricName: "areaUnderPR"}) == pytest.approx(expected[1])


def test_single_class_and_bad_scores(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert tuple(metrics.areas(one).first()) == (None, None, None)
    mixed = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, float("nan"))], "label int, score double")
    assert metrics.areas(mixed).first()["auc_roc"] == 1.0


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=2, max_size=25))
@settings(max_examples=8, deadline=None)
def test_reversed_scores_mirror_the_area(spark, data):
    df = spark.createDataFrame([(l, float(s)) for l, s in data], "label int, score double")
    a = metrics.areas(df).first()["auc_roc"]
    b = metrics.areas(df.withColumn("score", -F.col("score"))).first()["auc_roc"]
    assert (a is None) == (b is None)
    if a is not None:
        assert a + b == pytest.approx(1.0)


def test_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "label int, score double")
    assert rows(metrics.roc_points(df), "fpr", "tpr") == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    got = rows(metrics.pr_points(df).withColumn("precision", F.round("precision", 4)), "recall", "precision")
    assert got == [(0.0, 1.0), (0.5, 1.0), (1.0, 0.5), (1.0, 0.6667)]


def test_comparison_ranks_by_test_area(spark):
    good = [("good", s, l, l, 0.9 if l else 0.1) for s in ("valid", "test") for l in (0, 1)]
    bad = [("bad", s, l, 1 - l, 0.1 if l else 0.9) for s in ("valid", "test") for l in (0, 1)]
    df = spark.createDataFrame(good + bad, "model string, split string, label int, prediction int, score double")
    got = {r["model"]: r for r in metrics.model_comparison(df).collect()}
    assert (got["good"]["position"], got["bad"]["position"]) == (1, 2)
    assert got["good"]["val_accuracy"] == 1.0 and got["bad"]["test_auc_roc"] == 0.0


def run_table(spark):
    return spark.createDataFrame(
        [
            ("r1", "a", "x", 1, {"f1": 0.5, "acc": 0.9}, None),
            ("r2", "b", "x", 3, {"f1": 0.7}, {"k": "v"}),
            ("r3", "c", "y", 2, {"f1": float("nan"), "acc": None}, {}),
        ],
        "run_id string, run_name string, experiment string, start_time int, metrics map<string,double>, tags map<string,string>",
    )


def test_best_run_and_history(spark):
    table = run_table(spark)
    assert tuple(runs.best_run(table, "f1").first()) == ("f1", "r2", "b", 0.7)
    assert tuple(runs.best_run(table, "acc").first()) == ("acc", "r1", "a", 0.9)
    assert runs.best_run(table, "nothing").count() == 0
    history = runs.run_history(table, ["acc"], "x").collect()
    assert [(r["run_id"], r["acc"]) for r in history] == [("r2", 0.0), ("r1", 0.9)]
    assert rows(runs.experiments(table)) == [("x",), ("y",)]
    tags = {r["run_id"]: r["tags"] for r in runs.with_best_tags(table, {"best_f1": "f1", "best_acc": "acc"}).collect()}
    assert tags == {"r1": {"best_acc": "true"}, "r2": {"k": "v", "best_f1": "true"}, "r3": {}}


def test_topk_ties_by_name(spark):
    df = spark.createDataFrame([(f"f{i:02d}", 0.1) for i in range(20)] + [("top", 0.9)], "feature string, importance double")
    got = [r["feature"] for r in runs.topk_features(df).collect()]
    assert got == ["top", *[f"f{i:02d}" for i in range(14)]]
