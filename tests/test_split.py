"""The exact stratified split against sorting on one machine."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from frames import rows
from riskmart.operators import joins, split


def by_hand(data, ratio, salt="outer:42:"):
    """(key, class, part) for (key, class) rows with distinct keys in each class."""
    classes = defaultdict(list)
    for key, label in data:
        classes[label].append((hashlib.md5(f"{salt}{'' if key is None else key}".encode()).hexdigest(), key))
    out = []
    for label, members in classes.items():
        first = math.floor(ratio * len(members) + 0.5)
        out += [(key, label, "train" if i < first else "test") for i, (_, key) in enumerate(sorted(members))]
    return sorted(out, key=repr)


def skewed(n=4_000):
    """A third of the rows in one class, a rare class, a class of one row, and nulls."""
    return [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else "rare" if i % 59 == 0 else f"c{i % 7}") for i in range(n)] + [(n, "single"), (None, "hot")]


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_every_class_has_its_share(spark, ratio):
    data = skewed()
    df = spark.createDataFrame(data, "k int, c string")
    assert rows(split.stratified_split(df, "k", "c", ratio)) == by_hand(data, ratio)


def test_any_partitioning_and_both_joins(spark, monkeypatch):
    data = skewed(900)
    df = spark.createDataFrame(data, "k int, c string")
    want = by_hand(data, 0.8)
    for n in (1, 2, 7):
        assert rows(split.stratified_split(df.repartition(n), "k", "c")) == want
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)  # nothing fits: the salted join
    assert rows(split.stratified_split(df, "k", "c")) == want


def test_one_bucket_is_ranked_exactly(spark, monkeypatch):
    """With a single histogram bucket everything is ranked, with many nothing but the cut is: the same split."""
    data = skewed(600)
    df = spark.createDataFrame(data, "k int, c string")
    for digits in (0, 1, 8):
        monkeypatch.setattr(split, "PREFIX", digits)
        assert rows(split.stratified_split(df, "k", "c", 0.37)) == by_hand(data, 0.37)


def test_several_class_columns_seeds_and_levels(spark):
    df = spark.range(1_000).select("id", (F.col("id") % 2 == 0).alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.lit(1).alias("split"))
    got = split.stratified_split(df, "id", ["a", "b"], 0.7)
    assert got.columns == ["id", "a", "b", "split"]
    assert {tuple(r) for r in got.groupBy("a", "b", "split").count().select("split", "count").collect()} == {("train", 70), ("test", 30)}
    first = rows(got, "id", "split")
    assert first != rows(split.stratified_split(df, "id", ["a", "b"], 0.7, seed=1), "id", "split")
    assert first != rows(split.stratified_split(df, "id", ["a", "b"], 0.7, level="inner"), "id", "split")
    with pytest.raises(ValueError):
        split.stratified_split(df, "id", "a", -0.1)


def test_empty_tables_and_repeated_keys(spark):
    df = spark.createDataFrame([], "k int, c string")
    assert split.stratified_split(df, "k", "c").count() == 0
    same = spark.createDataFrame([(1, "x")] * 6 + [(2, "x")] * 4, "k int, c string")
    parts = {r["k"]: r["split"] for r in split.stratified_split(same, "k", "c", 0.5).collect()}
    assert len(parts) == 2  # rows of one key are never torn apart


def test_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2_000).select("id", (F.col("id") % 2).alias("c"), F.repeat(F.lit("x"), F.lit(50)).alias("wide")).write.parquet(path)
    plan = split.stratified_split(spark.read.parquet(path), "id", "c")._jdf.queryExecution().executedPlan().toString()
    for block in plan.split("Exchange")[1:]:
        assert "wide" not in block.splitlines()[0]
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
