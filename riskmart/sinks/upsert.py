"""Replacing some keys of a table instead of the whole table.

A day's changes touch few of a large table's files. Which ones they are is answered by the key column alone: the changed
keys go to the scan as a filter (each key up to ``PUSHED_KEYS`` of them, the range from least to largest beyond), where
row groups are left out by their least and largest values and their Bloom filters, and what is read is matched exactly.
Only files that hold a changed key are read whole and written again, with the changed rows in them; all others stay as
they are, under their names. The new files take their places by renames that a cut-short job leaves to be finished.

Cost: the key column of the row groups that may match, and the touched files. A table laid out by its key
(:func:`~riskmart.sinks.writers.keyed_writer`) is touched in few files; one in random order in most.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.joins import lookup_join
from riskmart.sinks import writers
from riskmart.sinks.scratch import written

PUSHED_KEYS = 1_000


class Replaced(NamedTuple):
    rows: int
    files_kept: int
    files_rewritten: int


def replace_by_key(changes: DataFrame, path: str, key: str, partition: str | None = None, pushed_keys: int = PUSHED_KEYS) -> Replaced:
    """The rows of ``changes`` take the place of the table's rows with the same keys; new keys are added.

    ``partition`` is the column the table is partitioned by, if any; a key may move to another partition. All rows that
    ``changes`` has for a key are kept, repeated ones too. Null is a key like any other. No changes leave every file as
    it is; a table that is not there yet is written whole. ``changes`` must have the table's columns and types (in any
    order), and may be read from the table itself: it is written aside first.
    """
    spark = changes.sparkSession
    writers.restore(spark, path)
    files, make = writers._files(spark, path)
    if not files.exists(make(path)):
        rows = writers.replace_keyed_table(changes, path, key, partition)
        return Replaced(rows, 0, len(spark.read.parquet(path).inputFiles()))
    table = spark.read.parquet(path)
    changes = written(_like(changes, table), "changes")
    keys = written(changes.select(F.col(key).alias("key")).distinct(), "changed-keys")
    touched = touched_files(table, keys, key, pushed_keys)
    n_files = len(table.inputFiles())
    new = changes
    if touched:
        old = spark.read.schema(table.schema).option("basePath", path).parquet(*touched)
        new = changes.unionByName(_unchanged(old, keys, key))
    elif changes.isEmpty():
        return Replaced(writers.count_written(changes, path), n_files, 0)
    root = files.makeQualified(make(path)).toString() + "/"
    below = [name.removeprefix(root) for name in touched]
    writers.updated_files(spark, path, writers.keyed_writer(new, key, partition).parquet, below)
    return Replaced(writers.count_written(changes, path), n_files - len(touched), len(touched))


def _like(changes: DataFrame, table: DataFrame) -> DataFrame:
    """The changes in the table's order of columns, if they are its columns."""
    want, have = ({f.name: f.dataType.simpleString() for f in df.schema.fields} for df in (table, changes))
    if want != have:
        raise ValueError(f"changes must have the table's columns {want}, not {have}")
    return changes.select(*[f"`{c}`" for c in table.columns])


def _has_null(keys: DataFrame) -> bool:
    return not keys.filter("key is null").isEmpty()


def touched_files(table: DataFrame, keys: DataFrame, key: str, pushed_keys: int = PUSHED_KEYS) -> list[str]:
    """Paths of the table's files that hold a row with one of ``keys`` (column ``key``, distinct).

    As many paths at most as the table has files, which the driver lists for any scan.
    """
    found = table.select(F.col(key).alias("key"), table.metadataColumn("_metadata").getField("file_path").alias("file"))
    known = keys.filter("key is not null")
    low, high, n = known.agg(F.min("key"), F.max("key"), F.count(F.lit(1))).first()
    files = found.filter("key is null") if _has_null(keys) else found.limit(0)
    if n and n <= pushed_keys:
        files = files.union(found.filter(F.col("key").isin([r["key"] for r in known.collect()])))
    elif n:
        files = files.union(lookup_join(found.filter(F.col("key").between(low, high)), known, ["key"], "left_semi"))
    make = table.sparkSession.sparkContext._jvm.java.net.URI
    path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    return sorted(path(make(r["file"])).toString() for r in files.select("file").distinct().collect())


def _unchanged(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the touched files whose keys did not change; a key with a third of the rows is spread like in any lookup."""
    hidden = [f"c{i}" for i in range(len(old.columns))]
    at = hidden[old.columns.index(key)]
    changed = keys.filter("key is not null").select(F.col("key").alias(at), F.lit(True).alias("changed"))
    stay = lookup_join(old.toDF(*hidden), changed, [at]).filter("changed is null")
    if _has_null(keys):
        stay = stay.filter(F.col(at).isNotNull())
    return stay.select(*[F.col(h).alias(name) for h, name in zip(hidden, old.columns)])
