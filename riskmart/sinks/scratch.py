"""Tables that a job writes for itself, in the folder that all its machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Where the session names none, a temporary one is made if driver and executors are one process; on a
    cluster each machine would write to its own disk, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return _OWN_FOLDER.setdefault("path", "file://" + tempfile.mkdtemp(prefix="riskmart-"))


def run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/riskmart-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder; call it once its results are stored elsewhere."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
