"""Pipeline stages of our own: saved, loaded and applied with the model they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.numeric import class_probability
from riskmart.operators import features


class FeatureSteps(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """From rows of the wide table to complete numeric rows, as the classifiers read them.

    Flags become 0/1, funding and log features are added where their columns exist, and rows that lack a
    feature are dropped (``dropIncomplete``). ``featureCols`` are the columns that the model reads: when they are set
    only they decide whether a row is complete, and a row that lacks one of the columns altogether is an error that names it.
    A label column may be absent, as in rows to be scored; where it is there it becomes 0/1 (null: 0) but never decides.
    """

    target = Param(Params._dummy(), "target", "label column", TypeConverters.toString)
    flags = Param(Params._dummy(), "flags", "boolean columns that become 0/1", TypeConverters.toListString)
    includeBoolean = Param(Params._dummy(), "includeBoolean", "turn every boolean column into 0/1", TypeConverters.toBoolean)
    fundsCol = Param(Params._dummy(), "fundsCol", "obligated money", TypeConverters.toString)
    totalCol = Param(Params._dummy(), "totalCol", "estimated money", TypeConverters.toString)
    featureCols = Param(Params._dummy(), "featureCols", "columns that the model reads", TypeConverters.toListString)
    dropIncomplete = Param(Params._dummy(), "dropIncomplete", "drop rows that lack a feature", TypeConverters.toBoolean)

    def __init__(self, target: str = "is_terminated", flags: Sequence[str] = ("has_flagged_words",), **params):
        super().__init__()
        self._setDefault(
            target="is_terminated", flags=["has_flagged_words"], includeBoolean=False, fundsCol="funds_obligated_amt",
            totalCol="estimated_total_amt", featureCols=[], dropIncomplete=True,
        )
        self._set(target=target, flags=list(flags), **params)

    def of(self, param: str):
        return self.getOrDefault(param)

    def with_features(self, names: Sequence[str]) -> "FeatureSteps":
        """The same steps for a fitted model's columns."""
        made = self.copy()
        return made._set(featureCols=list(names))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        flags = [self.of("target"), *self.of("flags")]
        if self.of("includeBoolean"):
            flags += [name for name, dtype in dataset.dtypes if dtype == "boolean"]
        funds, total = self.of("fundsCol"), self.of("totalCol")
        made = features.bool_to_int(dataset, flags)
        made = features.log_features(features.funding_features(made, funds, total), funds, total)
        wanted = self.of("featureCols")
        absent = [c for c in wanted if c not in made.columns]
        if absent:
            raise ValueError(f"rows to be scored lack the columns {absent}")
        return features.complete_cases(made, wanted or None) if self.of("dropIncomplete") else made


def carried(model: PipelineModel, steps: FeatureSteps, names: Sequence[str]) -> PipelineModel:
    """A fitted model that starts from the rows of the wide table."""
    return PipelineModel(stages=[steps.with_features(names), *model.stages])


def predictions(model: PipelineModel, df: DataFrame, target: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``label, prediction, score`` of rows that need not be labelled (null label)."""
    scored = model.transform(df)
    label = F.col(target).cast("int") if target and target in scored.columns else F.lit(None).cast("int")
    return scored.select(*keep, label.alias("label"), F.col("prediction").cast("int").alias("prediction"), class_probability("probability").alias("score"))
