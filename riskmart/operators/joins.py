"""Joining a big table to a keyed lookup table, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
TASK_BYTES = 128 * 1024 * 1024
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text and binary by length, nested ones as their JSON, others as 8-byte words."""
    words = 0
    sized = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sized.append(F.octet_length(f.name))
        elif isinstance(f.dataType, _NESTED):
            sized.append(F.octet_length(F.to_json(F.struct(f.name))))
        else:
            words += 1
    return sum((F.coalesce(x, F.lit(0)).cast("bigint") for x in sized), F.lit(8 * words).cast("bigint"))


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of values, in one pass."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return found["n"], found["b"]


def fits(size: tuple[int, int], max_rows: int, times: int = 1) -> bool:
    """Whether ``times`` copies of a measured table may be broadcast."""
    n_rows, n_bytes = size
    return n_rows * times <= max_rows and n_bytes * times <= BROADCAST_BYTES


def _hot_keys(fact: DataFrame, on: Sequence[str], task_bytes: int) -> DataFrame:
    """Keys whose rows have more bytes than one task should hold, and over how many tasks to spread each.

    There are fewer of them than tasks of that size in the whole table, so that they can be broadcast.
    """
    sized = fact.select(*on, row_bytes(fact).alias("_bytes"))
    per_key = sized.groupBy(*on).agg(F.sum("_bytes").alias("_bytes")).dropna(subset=list(on))
    return per_key.filter(F.col("_bytes") > task_bytes).select(*on, F.ceil(F.col("_bytes") / task_bytes).cast("int").alias("_tasks"))


def _salt(fact: DataFrame, tasks: Column) -> Column:
    """From the row and the task that reads it: equal rows spread, and so do those of one input partition.

    It is the same when a lost task runs again.
    """
    values = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() else F.col(f.name) for f in fact.schema.fields]
    return F.pmod(F.xxhash64(*values) + F.spark_partition_id(), tasks).cast("int")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Join ``fact`` (any key skew, null keys included) to ``lookup`` (unique on ``on``, narrow).

    The lookup is measured first. Up to ``broadcast_rows`` rows and a fixed number of bytes it is
    broadcast and the fact is not shuffled. Beyond that both sides are shuffled by key and salt:
    the bytes of the fact's keys are added up, a key of more than ``task_bytes`` gets as many
    salts as it fills tasks, and only its one lookup row is repeated that often; all other keys have
    one salt. Rows with a null key match nothing and spread freely. Either way the result is the
    plain join, and the fact is read twice.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    if fits(measure(lookup), broadcast_rows):
        return fact.join(F.broadcast(lookup), on, how)
    hot = F.broadcast(_hot_keys(fact, on, task_bytes))
    no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    tasks = F.when(no_key, F.lit(1 << 20)).otherwise(F.coalesce("_tasks", F.lit(1)))
    salt = _salt(fact, tasks)
    salted = fact.join(hot, on, "left").withColumn("_salt", salt).drop("_tasks")
    repeated = (
        lookup.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1)))
        .drop("_tasks")
    )
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
