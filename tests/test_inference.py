"""Types of text columns against a loop over the values."""

from __future__ import annotations

import re
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import rows
from riskmart.sources import inference


def holds(value, kind):
    """Whether one text can be of a type, by Python."""
    if kind == "boolean":
        return value.lower() in ("true", "false")
    if kind in ("int", "bigint"):
        bits = 31 if kind == "int" else 63
        return bool(re.fullmatch("0|-?[1-9][0-9]*", value, re.A)) and -(2 ** bits) <= int(value) < 2 ** bits
    if kind == "double":
        return bool(re.fullmatch(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?", value, re.A)) and abs(float(value)) != float("inf")
    shapes = ["%Y-%m-%d"] if kind == "date" else ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S"]
    for shape in shapes:
        try:
            if datetime.strptime(value, shape).strftime(shape) == value:
                return True
        except ValueError:
            pass
    return False


def by_hand(values):
    some = [v for v in values if v]
    if not some:
        return "void"
    return next((t for t in inference.TYPES if all(holds(v, t) for v in some)), "string")


VALUES = st.one_of(
    st.none(), st.sampled_from(["", "true", "False", "0", "007", "-0", "-5", "+5", " 5", "1.50", "1e3", ".5", "5.", "1e999", "NaN", "12,5",
                                "2147483647", "2147483648", "-2147483648", "9223372036854775807", "9223372036854775808", "2024-02-29", "2023-02-29",
                                "2024-01-01 10:20:30", "2024-01-01T10:20:30", "2024-13-01", "x", "٣"]),
    st.integers(-10**20, 10**20).map(str), st.floats(allow_nan=False, allow_infinity=False).map(repr),
)


@given(st.lists(st.lists(VALUES, min_size=4, max_size=4), min_size=1, max_size=8))
@settings(max_examples=25, deadline=None)
def test_types_by_hand(spark, table):
    # Each value alone, and columns of several: one pass over all.
    df = spark.createDataFrame([tuple(r) for r in table], "a string, b string, c string, d string")
    found = {r["column"]: r for r in inference.decided(inference.type_counts(df)).collect()}
    for name, values in zip("abcd", zip(*table)):
        assert found[name]["type"] == by_hand(values), values
        assert found[name]["n_rows"] == len(values) and found[name]["n_values"] == sum(bool(v) for v in values)
        for t in inference.TYPES:
            assert found[name][f"n_{t}"] == sum(holds(v, t) for v in values if v), (t, values)


def test_parts_merge_to_the_whole(spark):
    df = spark.range(60).select(
        F.when(F.col("id") < 59, F.col("id").cast("string")).otherwise("0059").alias("code"), F.col("id").cast("string").alias("n"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("day"),
    )
    parts = [inference.type_counts(df.filter(F.col("n").cast("int") % 3 == i)) for i in range(3)]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(inference.merged(union)) == rows(inference.type_counts(df))
    types = {r["column"]: r["type"] for r in inference.decided(inference.merged(union)).collect()}
    assert types == {"code": "string", "n": "int", "day": "date"}  # one leading zero keeps them all


def test_csv_in_its_types(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,zip,amount,when,Odd name\n1,01234,1.5,2024-01-01,x\n2,99999,,2024-01-02,\n3,1\n")
    (folder / "b.csv").write_text("id,zip,amount,when,Odd name\n3000000000,00501,2,2024-01-03 10:00:00,7\n")
    df, counts = inference.read_csv_typed(spark, str(folder))
    kinds = dict(df.dtypes)
    assert (kinds["id"], kinds["zip"], kinds["amount"], kinds["when"], kinds["Odd name"]) == ("bigint", "string", "double", "timestamp_ntz", "string")
    good = df.filter("_corrupt_record IS NULL").orderBy("id").collect()
    assert [r["zip"] for r in good] == ["01234", "99999", "00501"] and [r["amount"] for r in good] == [1.5, None, 2.0]
    assert {r["column"]: r["n_values"] for r in counts.collect()}["id"] == 3


def test_one_pass_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b string")
    assert rows(inference.decided(inference.type_counts(df)), "column", "type", "n_rows") == [("a", "void", 0), ("b", "void", 0)]
    assert inference.type_counts(df.select()).count() == 0
    path = str(tmp_path / "t")
    spark.range(9).select(F.col("id").cast("string").alias("a"), F.col("id").cast("string").alias("b")).write.parquet(path)
    plan = inference.type_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
