"""Table writers.

Row counts come back from the written files: Parquet answers them from its footers, and unlike
counters collected while writing they stay exact when lost tasks are run again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.sinks import layout


_PLAIN = ("parquet", "json", "csv", "orc")
# What a replacement keeps beside a table's folder for a while.
_NEW, _NEW_DONE, _OLD = ".being-written", ".written", ".replaced"
# What an update of some of a table's files keeps there: new files below ``rows``, the names of those they replace in ``gone``.
_UPDATE, _UPDATE_DONE = ".update-being-written", ".update"


def count_written(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    return df.sparkSession.read.format(fmt).load(path).count()


def _replacing(df: DataFrame, fmt: str):
    """A writer that replaces a table; formats that keep a schema apart from the files replace it too."""
    writer = df.write.format(fmt).mode("overwrite")
    return writer if fmt in _PLAIN else writer.option("overwriteSchema", "true")


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    context = spark.sparkContext
    make = context._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(context._jsc.hadoopConfiguration()), make


def restore(spark: SparkSession, path: str) -> None:
    """Finish or undo what was cut short: the newest whole copy of the table is at its path again."""
    files, make = _files(spark, path)
    if not files.exists(make(path)):
        for aside in (path + _NEW_DONE, path + _OLD):
            if files.exists(make(aside)) and files.rename(make(aside), make(path)):
                break
    _finish_update(spark, path)


def updated_files(spark: SparkSession, path: str, write, gone: Sequence[str]) -> None:
    """Put the files that ``write(folder)`` makes in the place of the table's files ``gone`` (names below ``path``).

    New files and the list of old ones are written aside, and one rename of their folder decides: before it the
    table is as it was; after it the update is carried through by whoever comes next, however often it is cut short.
    While files are moved, readers may meet old and new ones side by side, never too few.
    """
    files, make = _files(spark, path)
    files.delete(make(path + _UPDATE), True)
    write(f"{path}{_UPDATE}/rows")
    spark.createDataFrame([(name,) for name in gone], "value string").coalesce(1).write.text(f"{path}{_UPDATE}/gone")
    _rename(files, make(path + _UPDATE), make(path + _UPDATE_DONE))
    _finish_update(spark, path)


def _finish_update(spark: SparkSession, path: str) -> None:
    files, make = _files(spark, path)
    done = path + _UPDATE_DONE
    if not files.exists(make(done)):
        return
    gone = [r["value"] for r in spark.read.text(f"{done}/gone").collect()]
    root = files.makeQualified(make(f"{done}/rows")).toString()
    listed, names = files.listFiles(make(f"{done}/rows"), True), []
    while listed.hasNext():
        names.append(listed.next().getPath().toString()[len(root) + 1:])
    for name in names:
        target = make(f"{path}/{name}")
        if not target.getName().startswith(("_", ".")):
            files.mkdirs(target.getParent())
            _rename(files, make(f"{done}/rows/{name}"), target)
    for name in gone:
        files.delete(make(f"{path}/{name}"), False)
    files.delete(make(done), True)
    spark.catalog.refreshByPath(path)


def swapped_in(spark: SparkSession, path: str, write) -> None:
    """Replace a folder by what ``write(folder)`` makes: written aside in full, then put in place by renames.

    If writing fails, the table is as it was. If the job dies between the renames, a whole copy lies beside the path and
    the next replacement (or :func:`restore`) puts it back before anything else. Readers find the old or the new files,
    or for the moment between two renames none.
    """
    restore(spark, path)
    files, make = _files(spark, path)
    for aside in (_NEW, _NEW_DONE, _OLD):
        files.delete(make(path + aside), True)
    write(path + _NEW)
    _rename(files, make(path + _NEW), make(path + _NEW_DONE))  # from here on it counts as whole
    if files.exists(make(path)):
        _rename(files, make(path), make(path + _OLD))
    _rename(files, make(path + _NEW_DONE), make(path))
    files.delete(make(path + _OLD), True)
    spark.catalog.refreshByPath(path)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace the whole table; returns the rows written. The old one stays until the new one is whole."""
    if fmt in _PLAIN:
        swapped_in(df.sparkSession, path, lambda folder: df.write.format(fmt).save(folder))
    else:
        _replacing(df, fmt).save(path)
    return count_written(df, path, fmt)


def balanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows of one folder together, in files of the advisory size.

    A rebalance (unlike a plain repartition) lets adaptive execution split the folder that holds
    a third of the table over many tasks and merge the tiny ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace a table partitioned by ``by``; each partition's rows are written together."""
    if fmt in _PLAIN:
        swapped_in(df.sparkSession, path, lambda folder: balanced(df, *by).write.format(fmt).partitionBy(*by).save(folder))
    else:
        _replacing(balanced(df, *by), fmt).partitionBy(*by).save(path)


def write_json_partitions(df: DataFrame, path: str, by: str = "year", overwrite: bool = True) -> None:
    """JSON below ``by=...`` folders; overwriting touches only the partitions in ``df``."""
    writer = balanced(df, by).write.partitionBy(by)
    if overwrite:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.json(path)


def clear_json_partitions(spark: SparkSession, path: str, by: str, values: Iterable) -> None:
    """Replace partitions by nothing: a dynamic overwrite does not touch those that got no rows."""
    for value in values:
        spark.range(0).select("id").write.mode("overwrite").json(f"{path}/{by}={value}")


def keyed_writer(df: DataFrame, keys: str | Sequence[str], partition: str | None = None):
    """A Parquet writer of ``df`` laid out for lookups by ``keys``, those of them that exist.

    One key: rows are balanced over files by size, so a key value (or null) with a third of the rows is
    written by as many tasks as it needs, and inside a file they are sorted by the key. Several keys (and no
    partition column): rows follow a space-filling curve, so that a lookup by any of them skips most row
    groups. Every key column has a bloom filter.
    """
    names = {c.lower(): c for c in df.columns}
    tops = [k for k in ([keys] if isinstance(keys, str) else keys) if k.split(".")[0].lower() in names]
    partition = partition if partition and partition.lower() in names else None
    first = [partition] if partition else []
    if len(tops) > 1 and not partition:
        laid_out = layout.along_curve(df, tops)
    else:
        spread = df.hint("rebalance", *[F.col(c) for c in [*first, *tops[:1]]]) if first or tops else df
        laid_out = spread.sortWithinPartitions(*first, *tops[:1]) if first or tops else spread
    writer = laid_out.write
    for key in tops:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    return writer.partitionBy(partition) if partition else writer


def replace_keyed_table(df: DataFrame, path: str, keys: str | Sequence[str], partition: str | None = None) -> int:
    """Replace a Parquet table by the rows of ``df``, laid out for lookups by ``keys`` (:func:`keyed_writer`)."""
    swapped_in(df.sparkSession, path, keyed_writer(df, keys, partition).parquet)
    return count_written(df, path)


def write_report(df: DataFrame, path: str) -> None:
    """A small table (one row per model, class or feature) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
