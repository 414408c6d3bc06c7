"""Queries over the run table.

Columns: ``run_id, run_name, experiment, start_time, params map<string,string>,
metrics map<string,double>, tags map<string,string>``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.cleaning import nan_to_null


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the highest value of a metric; runs without it do not take part."""
    value = nan_to_null(F.col("metrics")[metric])
    top = runs.filter(value.isNotNull()).agg(
        F.max_by(F.struct("run_id", "run_name", value.alias("value")), F.struct(value, F.col("run_id"))).alias("r")
    )
    return top.filter("r IS NOT NULL").select(F.lit(metric).alias("metric"), "r.run_id", "r.run_name", "r.value")


def with_best_tags(runs: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Add ``{tag: 'true'}`` to the winner of each metric (``{tag: metric}``).

    The table itself is append-only; tags are derived when it is read. Each winner is a
    single-value subquery, not a join.
    """
    tagged = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    for tag, metric in tags.items():
        winner = best_run(runs, metric).select("run_id").scalar()
        mark = F.create_map(F.lit(tag), F.lit("true"))
        won = F.coalesce(F.col("run_id") == winner, F.lit(False))
        tagged = F.when(won, F.map_concat(tagged, mark)).otherwise(tagged)
    return runs.withColumn("tags", tagged)


def run_history(
    runs: DataFrame, metrics: Sequence[str], experiment: str | None = None, missing: float | None = 0.0
) -> DataFrame:
    """Runs newest first with the named metrics as columns; ``missing`` fills absent ones."""
    chosen = runs.filter(F.col("experiment") == experiment) if experiment is not None else runs
    values = [F.coalesce(F.col("metrics")[m], F.lit(missing).cast("double")).alias(m) for m in metrics]
    return chosen.select("run_id", "run_name", "experiment", "start_time", *values).orderBy(
        F.col("start_time").desc(), "run_id"
    )


def experiments(runs: DataFrame) -> DataFrame:
    return runs.select("experiment").distinct()


def topk_features(importances: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most important features, ties by name; a bounded heap per task, no full sort."""
    return importances.orderBy(F.col("importance").desc(), "feature").limit(k)
