"""Which files of a growing download folder are new: listed and told from those seen before by tasks, not by the driver.

A *ledger* is a folder of Parquet files that name the page files seen (``path``, below the source). The driver knows the
feed folders, of the new files their number in each of ``TASKS`` ranges of times, and the names of one batch of them; all
others stay in tables. Batches are noted one by one: if a run dies, the files not noted yet are found again by the next one.

The source is listed by pyarrow, a feed folder by one task: some 400 bytes a file while it is listed.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.session import ship_package

TASKS = 64
NAMES = 10_000
_PARTITION = 33  # monotonically_increasing_id: the partition is above these bits


def _hidden(name: str) -> bool:
    """Names that Spark's own listing leaves out."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _opened(source: str):
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(source)
    return files, root.rstrip("/")


def feed_folders(source: str, feed: str) -> list[str] | None:
    """Names of the folders ``<feed>=...`` of a source; None if pyarrow cannot list it, or it holds anything else."""
    from pyarrow import fs

    try:
        files, root = _opened(source)
        found = [f for f in files.get_file_info(fs.FileSelector(root)) if not _hidden(f.base_name)]
    except (OSError, ValueError, NotImplementedError):
        return None
    if any(f.type != fs.FileType.Directory or not f.base_name.startswith(f"{feed}=") for f in found):
        return None
    return sorted(f.base_name for f in found)


def _list(source: str):
    """A task that lists feed folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = _opened(source)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = files.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True, recursive=True))
                for start in range(0, len(found), NAMES):
                    some = [(f.path[len(root) + 1:], f.mtime_ns or 0) for f in found[start:start + NAMES] if f.type == fs.FileType.File]
                    some = [(path, modified) for path, modified in some if not any(map(_hidden, path.split("/")))]
                    yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in some], pa.string()), pa.array([s[1] for s in some], pa.int64())], names=["path", "modified"])

    return run


def noted(spark: SparkSession, ledger: str) -> DataFrame | None:
    """``path`` of the files in the ledger; None if there is no ledger yet."""
    try:
        return spark.read.schema("path string").parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_batches(spark: SparkSession, source: str, folders: list[str], ledger: str, files_per_batch: int) -> Iterator[list[str]]:
    """Files of the folders that the ledger does not have, in batches of at most ``files_per_batch``, oldest first.

    A batch is noted when the next one is asked for.
    """
    if not folders:
        return
    ship_package(spark)
    listed = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(TASKS, len(folders)))
    found = listed.mapInArrow(_list(source), "path string, modified bigint")
    old = noted(spark, ledger)
    new = found if old is None else found.join(old, "path", "left_anti")
    scratch = f"{ledger}-{uuid.uuid4().hex}"
    try:
        order = ("modified", "path")
        new.repartitionByRange(TASKS, *order).sortWithinPartitions(*order).select("path", F.monotonically_increasing_id().alias("at")).write.parquet(scratch)
        rows = spark.read.schema("path string, at bigint").parquet(scratch)
        sizes = sorted(map(tuple, rows.groupBy(F.shiftright("at", _PARTITION)).count().collect()))
        starts = [0, *accumulate(n for _, n in sizes)]

        def at(i: int) -> int:
            part = bisect_right(starts, i) - 1
            return (sizes[part][0] << _PARTITION) + i - starts[part]

        for first in range(0, starts[-1], files_per_batch):
            last = min(first + files_per_batch, starts[-1]) - 1
            batch = rows.filter(F.col("at").between(at(first), at(last))).select("path")
            yield [r["path"] for r in batch.collect()]
            batch.coalesce(1).write.mode("append").parquet(ledger)
    finally:
        remove(spark, scratch)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
