"""Deduplication, its report, key sets and reject splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_latest(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One whole row per key: the one that is last by ``latest``.

    Row equality in ``latest`` is broken by a hash of the row, so the survivor does not
    depend on partitioning. The planner keeps at most one row per key and map partition
    before the shuffle (a partial group limit), so a key holding a third of the table sends
    one row per map task.
    """
    order = [F.col(c).desc_nulls_last() for c in latest]
    # Maps have no hash of their own: their sorted entries stand for them.
    hashable = [
        F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields
    ]
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*hashable).desc())
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after a dedupe on ``keys`` and the number removed, in one pass.

    Null is a key value like any other here, as it is for the dedupe.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rows_removed"),
    )


def key_set(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Distinct non-null keys."""
    return df.select(key.alias(name)).filter(F.col(name).isNotNull()).distinct()


def tag_rejects(df: DataFrame, rules: Mapping[str, Column], name: str = "reject_reason") -> DataFrame:
    """First broken rule of each row, null for a good row. An undecidable rule is broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]
    return df.withColumn(name, F.coalesce(*broken))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    tagged = tag_rejects(df, rules)
    return tagged.filter("reject_reason IS NULL").drop("reject_reason"), tagged.filter("reject_reason IS NOT NULL")


def reject_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows accepted and rejected per reason; partial counts make it one tiny shuffle."""
    return (
        tag_rejects(df, rules)
        .groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
