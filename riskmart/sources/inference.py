"""Column types of text tables in one pass.

Every column is summed up as counts: how many values there are, and how many of them each type can hold without loss.
Counts of files, partitions or years add up, so that a new file costs one pass over itself, and the type of the whole is
decided from the sums. Types form a lattice:

    none < boolean < text,   none < integer < long < double < text,   none < date < timestamp < text

A column has the least type that holds *all* its values. A number with leading zeros is an identifier: one such value
makes its column text, as do values that a number would print differently only by a sign or a space (``+1``, `` 1``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.readers import read_csv
from riskmart.sources import schemas

#: From the narrowest to the widest; text holds everything.
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp")
COUNTS = ("n_rows", "n_values", *[f"n_{t}" for t in TYPES])
_WHOLE = r"^(0|-?[1-9][0-9]*)$"
_NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"


def fits(c: Column, kind: str) -> Column:
    """Whether a type holds a value as it is written; never null for a value."""
    if kind == "boolean":
        found = F.lower(c).isin("true", "false")
    elif kind in ("int", "bigint"):
        found = c.rlike(_WHOLE) & c.try_cast(kind).isNotNull()
    elif kind == "double":
        found = c.rlike(_NUMBER) & ~F.coalesce(F.abs(c.try_cast("double")) == float("inf"), F.lit(True))
    else:
        found = c.rlike(_DATE if kind == "date" else _TIME) & c.try_cast("timestamp_ntz").isNotNull()
    return F.coalesce(found, F.lit(False))


def type_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column`` and :data:`COUNTS`: one row per text column, from one pass; null and empty text are no values."""
    names = list(columns) if columns else df.columns
    if not names:
        return df.sparkSession.createDataFrame([], ", ".join(["column string", *[f"{n} bigint" for n in COUNTS]]))
    counted = df.agg(*[F.struct(
        F.lit(name).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(f"`{name}`") != "").alias("n_values"),
        *[F.count_if(fits(F.col(f"`{name}`"), t)).alias(f"n_{t}") for t in TYPES],
    ).alias(f"c{i}") for i, name in enumerate(names)])
    return counted.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(names))])))


def merged(counts: DataFrame) -> DataFrame:
    """Counts of several tables, files or years as one row per column."""
    return counts.groupBy("column").agg(*[F.sum(n).alias(n) for n in COUNTS])


def decided(counts: DataFrame) -> DataFrame:
    """``column, type`` and the counts: the least type that holds all values; ``void`` without any."""
    kind = F.when(F.col("n_values") == 0, F.lit("void"))
    for t in TYPES:
        kind = kind.when(F.col(f"n_{t}") == F.col("n_values"), F.lit(t))
    return counts.withColumn("type", kind.otherwise("string"))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns in their types; empty text is null where the type is not text. ``void`` columns stay text."""
    casts = {}
    for name, kind in types.items():
        if name in df.columns and kind not in ("string", "void"):
            casts[name] = F.col(f"`{name}`").try_cast("timestamp_ntz" if kind == "timestamp" else kind)
    return df.withColumns(casts) if casts else df


def read_csv_typed(spark, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """A CSV file or folder in the types of all its values, and the counts that decided them.

    Malformed records take no part in the decision and stay in ``_corrupt_record``.
    """
    raw = read_csv(spark, path, multi_line)
    names = [c for c in raw.columns if c != schemas.CORRUPT]
    # The corrupt column alone cannot be asked for from text files, so it is asked for with the others.
    good = raw.filter(F.col(schemas.CORRUPT).isNull()).select(*[F.col(f"`{n}`") for n in names])
    counts = decided(type_counts(good))
    types = {r["column"]: r["type"] for r in counts.select("column", "type").collect()}  # one row per column
    return typed(raw, types), counts
