"""Profiles from sketches: exact when small, bounded when big, and the same merged as made at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmart.operators import profile


def found(df):
    return {r["column_name"]: r for r in df.collect()}


def test_small_tables_are_exact(spark):
    rows = [(2020 + i % 3, i % 7, f"t{i % 11}" if i % 5 else None, [i % 4], float("nan") if i % 9 == 0 else i / 2, None) for i in range(90)]
    df = spark.createDataFrame(rows, "year int, n int, t string, a array<int>, d double, nothing string")
    got = found(profile.merged_profile(profile.profile_sketches(df, "year")))
    assert {k: (v["n_rows"], v["n_filled"], v["n_distinct"]) for k, v in got.items()} == {
        "n": (90, 90, 7), "t": (90, 72, 11), "a": (90, 90, 4), "d": (90, 90, 81), "nothing": (90, 0, 0)}
    assert got["n"]["p50"] == 3 and got["t"]["p50"] is None and got["nothing"]["p25"] is None


def test_a_new_year_costs_one_year(spark, tmp_path):
    """Stored sketches of two years and those of a third give what all three give at once, within the bounds."""
    df = spark.range(120_000).select((2020 + F.col("id") % 3).alias("year"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("k"), F.sqrt("id").alias("v"))
    path = str(tmp_path / "sketches")
    profile.profile_sketches(df.filter("year < 2022"), "year").write.parquet(path)
    profile.profile_sketches(df.filter("year = 2022"), "year").write.mode("append").parquet(path)
    stored = found(profile.merged_profile(spark.read.parquet(path)))
    rebuilt = found(profile.merged_profile(profile.profile_sketches(df, "year")))
    exact = df.agg(F.count_distinct("k").alias("k"), F.count_distinct("v").alias("v")).first()
    for name in ("k", "v"):
        assert stored[name]["n_distinct"] == rebuilt[name]["n_distinct"] == pytest.approx(exact[name], rel=0.025)
        assert stored[name]["n_rows"] == 120_000
    for p, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        below = df.filter(F.col("v") <= stored["v"][p]).count() / 120_000
        assert below == pytest.approx(share, abs=0.02)


def test_empty_table(spark):
    df = spark.createDataFrame([], "year int, n int")
    assert profile.merged_profile(profile.profile_sketches(df, "year")).count() == 0
