"""Tables along a space-filling curve: both keys skip row groups, whatever their values."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from frames import rows
from riskmart.sinks import layout, writers


def groups(path):
    """Per row group: {column: (least, largest)}."""
    found = []
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
            found.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns if c.statistics and c.statistics.has_min_max})
    return found


def share_read(path, key, values):
    """Mean share of row groups whose range holds a value."""
    read = [g[key] for g in groups(path) if key in g]
    return sum(low <= v <= high for v in values for low, high in read) / len(read) / len(values)


def table(spark, n=40_000):
    """A number with a long tail, and a text key that has nothing to do with it; some nulls in each."""
    return spark.range(n).select(
        F.when(F.col("id") % 101 != 0, F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000)) / 10.0, 3).cast("long")).alias("funds"),
        F.when(F.col("id") % 103 != 0, F.concat(F.lit("grant-"), F.pmod(F.hash("id"), F.lit(5_000)).cast("string"))).alias("grant"),
        "id",
    )


def test_either_key_reads_under_a_quarter(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "t")
    layout.along_curve(df, ["funds", "grant"], files=64).write.parquet(path)
    assert len(groups(path)) >= 60
    funds = [r[0] for r in df.select("funds").dropna().orderBy("id").limit(200).collect()]
    grants = [r[0] for r in df.select("grant").dropna().orderBy("id").limit(200).collect()]
    assert share_read(path, "funds", funds) < 0.25 and share_read(path, "grant", grants) < 0.25
    assert rows(spark.read.parquet(path)) == rows(df)
    by_one = str(tmp_path / "one")
    df.repartitionByRange(64, "funds").sortWithinPartitions("funds").write.parquet(by_one)
    assert share_read(by_one, "grant", grants) > 0.9  # what the curve is for


def test_hot_values_are_cut(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"), "id")
    sizes = layout.along_curve(df, ["a", "b"], files=20).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2_500


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_ranks_by_hand(spark, bits):
    values = [None, *range(0, 60, 3)]
    df = spark.createDataFrame([(v,) for v in values], "k int")
    bounds = layout.range_bounds(df, ["k"], bits)[0]
    assert bounds == sorted(set(bounds)) and len(bounds) < 1 << bits
    got = df.select("k", layout._rank(F.col("k"), bounds, "int", bits).alias("r")).collect()
    assert all(r["r"] == (0 if r["k"] is None else sum(b <= r["k"] for b in bounds)) for r in got)


def test_curve_interleaves_bits(spark):
    df = spark.createDataFrame([(a, b, c) for a in range(8) for b in range(0, 8, 3) for c in (0, 5)], "a int, b int, c int")
    for r in df.withColumn("z", layout.curve_position([F.col("a"), F.col("b"), F.col("c")], 3)).collect():
        assert r["z"] == int("".join(f"{r[k] >> i & 1}" for i in (2, 1, 0) for k in "abc"), 2)


def test_keyed_table_of_several_keys(spark, tmp_path):
    df, path = table(spark, 3_000).withColumn("m", F.create_map(F.lit("x"), F.col("id"))), str(tmp_path / "k")
    assert writers.replace_keyed_table(df, path, ["grant", "funds"]) == 3_000
    assert rows(spark.read.parquet(path).drop("m")) == rows(df.drop("m"))
    assert writers.replace_keyed_table(df.limit(0), path, ["grant", "funds"]) == 0
    only_null = spark.createDataFrame([(None, None)] * 5, "grant string, funds int")
    assert writers.replace_keyed_table(only_null, path, ["grant", "funds"]) == 5
