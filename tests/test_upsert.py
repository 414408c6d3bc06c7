"""Replacing by key: the same rows as a full reload, and untouched files keep their names."""

from __future__ import annotations

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import rows
from riskmart.sinks import upsert, writers

SCHEMA = "id long, txt string, year int"


def files(path):
    return {os.path.relpath(os.path.join(d, n), path) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def reloaded(old, new):
    """What a full reload would hold."""
    changed = {r[0] for r in new}
    return sorted([r for r in old if r[0] not in changed] + list(new), key=repr)


def made(spark, path, old, files=10, partition=None):
    writer = spark.createDataFrame(old, SCHEMA).repartitionByRange(files, "id").sortWithinPartitions("id").write
    (writer.partitionBy(partition) if partition else writer).parquet(path)


OLD = [(i, f"t{i}", 2020 + i % 3) for i in range(1_000)]


@pytest.mark.parametrize("pushed", [1_000, 0])
@pytest.mark.parametrize("partition", [None, "year"])
def test_only_touched_files_are_written_again(spark, tmp_path, pushed, partition):
    path = str(tmp_path / "a table")
    made(spark, path, OLD, partition=partition)
    before = files(path)
    new = [(5, "new", 2021), (7, "a", 2020), (7, "b", 2022), (999, "z", 2020), (5_000, "added", 2024)]
    done = upsert.replace_by_key(spark.createDataFrame(new, SCHEMA), path, "id", partition, pushed)
    assert rows(spark.read.parquet(path), "id", "txt", "year") == reloaded(OLD, new)
    # 5, 7 and 999 lie in the first and the last range, in one file each, or one for each of their years
    touched = 2 if partition is None else 3
    assert done == (len(OLD) + 2, len(before) - touched, touched)
    assert len(before & files(path)) == len(before) - touched
    assert not [n for n in os.listdir(tmp_path) if n != "a table"]


def test_the_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    made(spark, path, OLD)
    table = spark.read.parquet(path)
    found = table.select("id", table.metadataColumn("_metadata").getField("file_path")).filter(F.col("id").isin([5, 7]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [5,7])" in plan and "ReadSchema: struct<id:bigint>" in plan


value = st.tuples(st.one_of(st.none(), st.integers(0, 30)), st.sampled_from(["a", None, ""]), st.integers(2020, 2022))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.lists(value, min_size=1, max_size=40), new=st.lists(value, max_size=15), pushed=st.sampled_from([0, 3, 100]))
def test_equals_a_full_reload(spark, tmp_path_factory, old, new, pushed):
    path = str(tmp_path_factory.mktemp("u") / "t")
    made(spark, path, old, files=4)
    upsert.replace_by_key(spark.createDataFrame(new, SCHEMA), path, "id", pushed_keys=pushed)
    assert rows(spark.read.parquet(path)) == reloaded(old, new)


def test_no_changes_and_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], SCHEMA)
    assert upsert.replace_by_key(spark.createDataFrame(OLD, SCHEMA), path, "id").rows == 1_000
    before = files(path)
    assert upsert.replace_by_key(none, path, "id") == (1_000, len(before), 0) and files(path) == before
    every = spark.read.parquet(path).withColumn("txt", F.lit("x"))  # from the table itself, all keys
    assert upsert.replace_by_key(every, path, "id").rows == 1_000
    assert not before & files(path) and spark.read.parquet(path).filter("txt <> 'x'").isEmpty()


def test_other_columns_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    made(spark, path, OLD)
    before = files(path)
    for bad in (spark.range(3), spark.createDataFrame([], "id int, txt string, year int")):
        with pytest.raises(ValueError, match="columns"):
            upsert.replace_by_key(bad, path, "id")
    assert files(path) == before


@pytest.mark.parametrize("renames", [0, 1, 2])
def test_a_job_that_died_is_carried_through(spark, tmp_path, monkeypatch, renames):
    """Before the first rename nothing has changed; from then on the next job finishes, also with half the files moved."""
    path = str(tmp_path / "t")
    made(spark, path, OLD, partition="year")
    changes = spark.createDataFrame([(5, "new", 2021), (999, "z", 2020)], SCHEMA)
    rename, left = writers._rename, [renames]

    def dying(*args):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        rename(*args)

    monkeypatch.setattr(writers, "_rename", dying)
    with pytest.raises(OSError, match="lost"):
        upsert.replace_by_key(changes, path, "id", "year")
    monkeypatch.undo()
    want = reloaded(OLD, [(5, "new", 2021), (999, "z", 2020)])
    writers.restore(spark, path)
    assert rows(spark.read.parquet(path), "id", "txt", "year") == (want if renames else sorted(OLD, key=repr))
    assert upsert.replace_by_key(changes, path, "id", "year").rows == len(OLD)
    assert rows(spark.read.parquet(path), "id", "txt", "year") == want


def test_a_full_replacement_ends_an_update(spark, tmp_path, monkeypatch):
    """A decided update is carried through before the table is replaced, and never comes back after."""
    path = str(tmp_path / "t")
    made(spark, path, OLD)
    monkeypatch.setattr(writers, "_finish_update", lambda *a: None)
    upsert.replace_by_key(spark.createDataFrame([(5, "new", 2021)], SCHEMA), path, "id")
    monkeypatch.undo()
    assert rows(spark.read.parquet(path)) == sorted(OLD, key=repr)  # decided, not yet done
    assert writers.replace_table(spark.createDataFrame(OLD[:3], SCHEMA), path) == 3
    assert upsert.replace_by_key(spark.createDataFrame([], SCHEMA), path, "id").rows == 3


def test_a_hot_key_is_spread(spark, tmp_path):
    """Two thirds of a touched file have the same unchanged key; beside it, beyond a broadcast, the rows stay whole."""
    path = str(tmp_path / "t")
    old = [(7 if i % 3 else i, f"t{i}", 2020) for i in range(600)]
    made(spark, path, old, files=1)
    new = [(i, "n", 2020) for i in range(0, 600, 6)]
    keys = spark.createDataFrame([(r[0],) for r in new], "key long")
    from riskmart.operators import joins

    stay = upsert._unchanged(spark.read.parquet(path), keys, "id")
    assert rows(stay) == sorted([r for r in old if r[0] not in {n[0] for n in new}], key=repr)
    spread = joins.lookup_join(spark.read.parquet(path), keys.withColumnRenamed("key", "id"), ["id"], "left_semi", broadcast_rows=0, task_bytes=2_000)
    assert rows(spread) == sorted([r for r in old if r[0] in {n[0] for n in new}], key=repr)
