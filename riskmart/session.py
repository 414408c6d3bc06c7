"""Session factory."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Planner settings the operators rely on: adaptive execution splits the partitions that a hot
# key makes too big (even where that costs a later stage a shuffle), and a side is broadcast
# without a count of its rows only below the threshold: the larger one holds for sizes measured while the query
# runs, the smaller one for guesses from compressed files, which rows in memory exceed many times.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A shuffled join whose every build partition turned out small is hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    # Tasks of the job that looks up many files by name (a stream batch has thousands): by default a task for each, and
    # every task sends the driver some 3 kB of its own beside the file's status.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "riskmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the planner settings to a session that somebody else created."""
    for key, value in DEFAULTS.items():
        if key != "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they run: Spark hands the archive on, once per application."""
    context = spark.sparkContext
    if getattr(context, "_riskmart_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskmart-"), "riskmart.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._riskmart_shipped = True
