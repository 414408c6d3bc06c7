"""Landing of new page files only.

A structured stream, run until it has caught up (``availableNow``): files seen before are not opened again, a backlog is
worked off in batches of ``FILES_PER_BATCH`` files, oldest first, and a run that died goes on where it stopped without landing a
row twice. Before it starts, new files are
found by tasks (:mod:`riskmart.sources.ledger`) and the pages of a batch at a time are written as a few Parquet files, which the
stream reads and which go when it has caught up. So the driver holds the names of one batch and not the name and
status of every file ever seen; a batch is landed as at most ``FILES_PER_FEED`` files for each feed, which the driver does
list, and the state is kept by RocksDB, outside of the heap. If a run dies after it has written pages and before it
has noted them, they are read again, and their awards dropped as any that come again.
Where pyarrow cannot list the source, and for checkpoints begun before there were ledgers, the stream lists the folder
itself (:func:`page_stream`), and the driver's memory grows with the number of files.

Awards that come again (a page downloaded twice, pages that overlap) are
dropped for ``HORIZON`` after their first arrival. Arrival is the time of the batch, so no row is ever late,
and the state holds the keys of one horizon, whatever the age of the feed; a repeat beyond it is left to the keyed dedupe of
formatting.

A file is read once, under its name: a page that was unreadable and has been mended comes in under a new name (or by
:func:`riskmart.plans.landing.land_awards`, which replaces whole years).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.plans.landing import awards_of
from riskmart.sources import ledger, schemas
from riskmart.sources.readers import page_columns

HORIZON = "30 days"
FILES_PER_BATCH = 10_000
FILES_PER_PART = 500
FILES_PER_FEED = 4
WRITERS = 32
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# The source leaves out files that are older by this than the newest one; its default of a week would lose copies that keep
# their old times. The price: the names of all files a stream has read are remembered on the driver (some 200 bytes each): a few
# for each batch, or, where it lists the folder itself, all.
MAX_FILE_AGE = "36500d"
_READER = {"multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}


def page_stream(spark: SparkSession, source: str, feed: str = "year", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Pages below ``<source>/<feed>=.../<offset>.json`` as they come; columns as :func:`page_columns` has them."""
    pages = (
        spark.readStream.schema(_schema(feed)).options(**_READER)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
        .json(source)
    )
    return _pages(pages, feed)


def _schema(feed: str) -> T.StructType:
    return schemas.with_corrupt(schemas.ENVELOPE).add(T.StructField(feed, T.StringType()))


def _pages(pages: DataFrame, feed: str) -> DataFrame:
    offset = F.regexp_extract("_metadata.file_name", r"(\d+)\.json", 1).try_cast("bigint")
    located = pages.select("response", schemas.CORRUPT, F.col(feed).alias("year"), offset.alias("offset"))
    return page_columns(located, F.col(schemas.CORRUPT).isNotNull())


def read_batch(spark: SparkSession, source: str, paths: list[str], feed: str = "year") -> DataFrame:
    """The same pages of some files, whose paths are below the source."""
    pages = (
        spark.read.schema(_schema(feed)).options(**_READER)
        .option("basePath", source)
        .option("__globPaths__", "false")  # names are taken as they are, as by a stream
        .json([f"{source.rstrip('/')}/{path}" for path in paths])
    )
    return _pages(pages, feed)


def new_pages(spark: SparkSession, source: str, folders: list[str], checkpoint: str, feed: str, files_per_batch: int) -> DataFrame | None:
    """A stream of the pages that are new, and of those that a run which died has left; None if there are none."""
    inbox, parts = f"{checkpoint}/pages", -(-files_per_batch // FILES_PER_PART)
    for paths in ledger.new_batches(spark, source, folders, f"{checkpoint}/files", files_per_batch):
        read_batch(spark, source, paths, feed).coalesce(parts).write.mode("append").parquet(inbox)
    if not _exists(spark, inbox):
        return None
    schema = "response " + schemas.ENVELOPE["response"].dataType.simpleString() + ", year string, offset bigint, n_rows int, failed boolean"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", parts).option("maxFileAge", MAX_FILE_AGE).parquet(inbox)


def new_awards(pages: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Awards of readable pages, each id of a feed once within the horizon. Awards without id are kept as they are told by nothing."""
    awards = awards_of(pages).withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    # Without an id every row is its own: a hash of the row keeps equal downloads together and others apart.
    told = F.coalesce(F.concat(F.lit("id:"), F.col("id")), F.concat(F.lit("row:"), F.md5(F.to_json(F.struct(*[F.col(c) for c in awards.columns if c != "_arrived"])))))
    return awards.withColumn("_told", told).dropDuplicatesWithinWatermark(["year", "_told"]).drop("_told", "_arrived")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def listed_by_driver(spark: SparkSession, n_files: int):
    """Up to so many files are looked up by the driver, which has their names: a job for it sends back 3 kB for each file.

    What it finds is not kept: by default up to 250 MB of statuses are, of files that are never read again.
    """
    return settings(spark, {
        "spark.sql.sources.parallelPartitionDiscovery.threshold": str(n_files),
        "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    })


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def land_new_pages(
    spark: SparkSession, source: str, target: str, checkpoint: str, feed: str = "year", horizon: str = HORIZON,
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Append the awards of files not seen before to the Parquet table ``target``, by ``year``; returns the rows added.

    ``checkpoint`` is a folder all machines share; it belongs to this source and target and is kept between runs.
    """
    before = landed(spark, target)
    rows = before.count() if before is not None else 0
    begun_without_ledger = _exists(spark, f"{checkpoint}/offsets")
    folders = None if begun_without_ledger else ledger.feed_folders(source, feed)
    with listed_by_driver(spark, files_per_batch), settings(spark, STATE):
        if folders is None:
            pages = page_stream(spark, source, feed, files_per_batch)
        else:
            pages = new_pages(spark, source, folders, checkpoint, feed, files_per_batch)
            if pages is None:
                return 0
        awards = new_awards(pages, horizon)
        stream = (
            awards.repartition(WRITERS, "year", F.pmod(F.xxhash64("id"), F.lit(FILES_PER_FEED))).writeStream.format("parquet")
            .partitionBy("year")
            .option("checkpointLocation", checkpoint if folders is None else f"{checkpoint}/stream")
            .option("path", target)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
    if folders is not None:
        ledger.remove(spark, f"{checkpoint}/pages")
    after = landed(spark, target)
    return (after.count() if after is not None else 0) - rows


def landed(spark: SparkSession, target: str) -> DataFrame | None:
    """The landed table, without files of batches that were not finished; None before the first batch."""
    schema = T.StructType([f for f in schemas.LANDED_AWARD.fields if f.name != "year"] + [T.StructField("year", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
