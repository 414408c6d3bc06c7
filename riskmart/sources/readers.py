"""File and zone readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sources import schemas
from riskmart.zones import Zones


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text, and malformed records whole in ``_corrupt_record``.

    A record with too few or too many fields is malformed. Without type inference the values are read
    once and identifiers keep their leading zeros; typing is left to the cleaning rules. Quoted line
    breaks need ``multi_line``, which reads a file in one task: right for lists; pass False for
    files that must be split and have none.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = schemas.with_corrupt(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .csv(path)
    )


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per element of a top-level JSON array, on one line or many."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines below partition folders such as ``year=2024``; the folder value becomes a column."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop("_id")


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None where nothing was written."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_required(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table; an absent or empty one ends the job before anything is overwritten."""
    df = read_optional(spark, path, fmt)
    if df is None or df.isEmpty():
        raise ValueError(f"no rows at {path}")
    return df


def load_split(spark: SparkSession, zones: Zones, split: str) -> DataFrame:
    """Train or test part of the wide table; only the folders of that part are read."""
    return spark.read.format(zones.fmt).load(zones.exploitation).filter(F.col("split") == split).drop("split")


def load_train(spark: SparkSession, zones: Zones) -> DataFrame:
    return load_split(spark, zones, "train")


def load_test(spark: SparkSession, zones: Zones) -> DataFrame:
    return load_split(spark, zones, "test")


def read_pages(spark: SparkSession, root: str, schema: T.StructType = schemas.ENVELOPE) -> DataFrame:
    """Page files ``<root>/year=<year>/<offset>.json``, one envelope each.

    Columns: the envelope, ``year``, ``offset`` (from the file name), ``n_rows`` and ``failed``
    (unreadable, or carrying a service notification). Files are spread over tasks by size, so
    a year with a third of all pages is read by as many tasks as its bytes need; a lost task is
    retried by the scheduler.
    """
    pages = (
        spark.read.schema(schemas.with_corrupt(schema))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(root)
    )
    located = pages.withColumn("offset", F.regexp_extract("_metadata.file_name", r"(\d+)\.json", 1).cast("bigint"))
    return page_columns(located, F.col(schemas.CORRUPT).isNotNull())


def page_columns(pages: DataFrame, corrupt: Column | None = None) -> DataFrame:
    """Parsed pages (``response``, ``year``, ``offset``) with ``n_rows`` and ``failed``."""
    response = F.col("response")
    bad = response.isNull() | F.col("response.serviceNotification").isNotNull()
    return pages.select(
        response,
        "year",
        "offset",
        F.coalesce(F.array_size("response.award"), F.lit(0)).alias("n_rows"),
        (bad if corrupt is None else corrupt | bad).alias("failed"),
    )
