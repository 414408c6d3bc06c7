"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sinks.scratch import shared_folder, written  # noqa: F401 - used by all operators

_CACHES: dict[str, list] = {}


def cached(owner: str, cache):
    """Note a worker-wide cache (anything with ``clear``) as its owner's."""
    _CACHES.setdefault(owner, []).append(cache)
    return cache


def only(owner: str) -> None:
    """Called by a task as it starts: a reused worker drops what other operators have cached in it."""
    for name, caches in _CACHES.items():
        if name != owner:
            for cache in caches:
                cache.clear()


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop input columns whose names (in any case) an operator is about to write."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def tidy(task):
    """Wrap a task over Arrow batches: when it ends, its worker gives freed memory back to the machine.

    Workers are reused and outlive their tasks; without this each keeps the most it ever held.
    """

    def run(batches):
        try:
            yield from task(batches)
        finally:
            _give_back()

    return run


def _give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def slices(batches, rows: int = 1_000):
    """Arrow batches cut into pieces, so that what a task makes of a piece stays small; long texts come one by one."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def hide(df: DataFrame, *needed: str) -> tuple[DataFrame, list[str], list[Column]]:
    """Give all columns neutral names while an operator works, so that none can clash with its own.

    Returns the renamed frame, the new names of the needed columns, and the columns under their old names.
    """
    hidden = [f"in{i}_" for i in range(len(df.columns))]
    place = {name.lower(): h for name, h in zip(df.columns, hidden)}
    restored = [F.col(h).alias(name) for name, h in zip(df.columns, hidden)]
    return df.toDF(*hidden), [place[n.lower()] for n in needed], restored


def row_hash(df: DataFrame, skip: Iterable[str] = ()) -> Column:
    """A hash of all other columns: the last tie-break, after which rows are interchangeable."""
    skipped = {s.lower() for s in skip}
    return F.xxhash64(*[
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in df.schema.fields if f.name.lower() not in skipped
    ], F.lit(0))


def lowest(rows: DataFrame, hash_col: str, limit: int, total: int, *ties: str) -> DataFrame:
    """The ``limit`` rows of ``total`` with the least 64-bit hashes: a bounded sample, the same in every run.

    Hashes spread evenly, so rows far above the expected cut are left out where they lie and the final
    sort sees about four times the limit, not the best rows of every task.
    """
    share = F.shiftrightunsigned(F.col(hash_col).bitwiseXOR(F.lit(-(1 << 63))), 11) / float(1 << 53)
    some = rows.filter(share <= 4.0 * limit / total) if total > 4 * limit else rows
    return some.orderBy(hash_col, *ties).limit(limit)


HOT_KEYS = 4_096


def join_by_hot(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """Left join of ``rows`` to a table with one row per key that knows each key's number of rows.

    The ``HOT_KEYS`` largest keys are joined by broadcasting their rows (a fixed number, of a few
    columns each); every other key has less than 1/``HOT_KEYS`` of the rows and is joined by shuffle.
    ``rows`` is read twice and should be a written table.
    """
    hot = F.broadcast(table.orderBy(F.desc(size), key).limit(HOT_KEYS).withColumn("hot_", F.lit(True)))
    tried = rows.join(hot, key, "left")
    added = [c for c in table.columns if c != key]
    rest = tried.filter("hot_ is null").drop("hot_", *added).join(table, key, "left")
    return tried.filter("hot_").drop("hot_").unionByName(rest)


BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make a session ready for Python workers that read whole texts.

    They get this package, wherever they run and whatever folder they start in: Spark's own file server
    hands the archive from the driver to the executors, once per application. And where the session has
    Spark's default of 10,000 rows a batch, which texts of several kB make into tens of MB on either
    side of the pipe, it gets ``BATCH_ROWS``.
    """
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_riskmart_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskmart-"), "riskmart.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._riskmart_shipped = True
