"""Feature steps that travel with the saved model."""

from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from frames import ROOT, rows
from riskmart.ml import models
from riskmart.ml.models import ModelSpec
from riskmart.ml.stages import FeatureSteps, carried, predictions
from riskmart.operators import features
from riskmart.plans import training
from riskmart.sinks import writers

SCHEMA = (
    "award_id string, is_terminated boolean, has_flagged_words boolean, in_cruz_list boolean, estimated_total_amt double, "
    "funds_obligated_amt double, flagged_word_count_abstract int, title string, year int"
)


def raw(spark, n=300):
    """Rows of the wide table, some with gaps, an estimate of -1, NaN and a null flag."""
    def row(i):
        estimate = None if i % 29 == 0 else -1.0 if i % 31 == 0 else float(100 + i * 7 % 90)
        funds = float("nan") if i % 37 == 0 else float(i * 13 % 80)
        return (f"a{i}", None if i % 41 == 0 else i % 3 == 0, i % 2 == 0, i % 5 == 0, estimate, funds, i * 5 % 11, "t", 2020 + i % 3)

    return spark.createDataFrame([row(i) for i in range(n)], SCHEMA)


@pytest.fixture
def saved(spark, tmp_path):
    frame = training.feature_frame(raw(spark))
    names = features.feature_columns(frame, "is_terminated", drop=("award_id",))
    fitted = models.fit(ModelSpec(models.LOGISTIC), features.class_weights(frame, "is_terminated"), "is_terminated", names)
    path = str(tmp_path / "model")
    writers.save_model(carried(fitted, FeatureSteps(), names), path)
    return fitted, names, path


def test_steps_are_the_feature_frame(spark):
    by_hand = features.complete_cases(features.log_features(features.funding_features(features.bool_to_int(raw(spark), ["is_terminated", "has_flagged_words"]))))
    assert rows(FeatureSteps().transform(raw(spark))) == rows(by_hand) == rows(training.feature_frame(raw(spark)))
    every = FeatureSteps(includeBoolean=True).transform(raw(spark))
    assert dict(every.dtypes)["in_cruz_list"] == "int"
    assert FeatureSteps(dropIncomplete=False).transform(raw(spark)).count() == 300


def test_a_loaded_model_scores_raw_rows(spark, saved):
    fitted, _, path = saved
    want = models.score(fitted, training.feature_frame(raw(spark)), "is_terminated", ["award_id"])
    model = PipelineModel.load(path)
    assert rows(predictions(model, raw(spark), "is_terminated", ["award_id"])) == rows(want)
    unlabelled = predictions(model, raw(spark).drop("is_terminated", "title"), "is_terminated", ["award_id"])
    assert rows(unlabelled, "award_id", "prediction", "score") == rows(want, "award_id", "prediction", "score")
    assert unlabelled.filter("label IS NOT NULL").isEmpty()


def test_parameters_come_back(spark, saved, tmp_path):
    _, names, path = saved
    steps = PipelineModel.load(path).stages[0]
    assert isinstance(steps, FeatureSteps) and steps.of("featureCols") == names and steps.of("dropIncomplete")
    other = FeatureSteps("y", ["f"], fundsCol="f", totalCol="e", includeBoolean=True, dropIncomplete=False)
    other.write().overwrite().save(str(tmp_path / "steps"))
    back = FeatureSteps.load(str(tmp_path / "steps"))
    assert {p.name: back.of(p.name) for p in back.params} == {p.name: other.of(p.name) for p in other.params}


def test_absent_columns_are_named(spark, saved):
    model = PipelineModel.load(saved[2])
    with pytest.raises(ValueError, match="flagged_word_count_abstract"):
        model.transform(raw(spark).drop("flagged_word_count_abstract"))


def test_only_features_decide_at_scoring(spark, saved):
    """A numeric column that the model never reads may be empty without losing the row."""
    model = PipelineModel.load(saved[2])
    df = raw(spark).withColumn("unread", F.lit(None).cast("double"))
    assert predictions(model, df).count() == predictions(model, raw(spark)).count() > 0


def test_another_process_loads_it(spark, saved, tmp_path):
    """A session of its own, which has only the saved model and the raw rows."""
    data, out = str(tmp_path / "raw"), str(tmp_path / "scores")
    raw(spark).write.parquet(data)
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.ml import PipelineModel
from riskmart.ml.stages import predictions
from riskmart.session import build_session
spark = build_session("fresh", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
predictions(PipelineModel.load({saved[2]!r}), spark.read.parquet({data!r}), "is_terminated", ["award_id"]).write.parquet({out!r})
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    want = models.score(saved[0], training.feature_frame(raw(spark)), "is_terminated", ["award_id"])
    assert rows(spark.read.parquet(out)) == rows(want)
