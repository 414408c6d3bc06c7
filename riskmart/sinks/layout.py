"""Row order for tables that are looked up by several keys.

A table can be sorted by one key only; a lookup by another then meets every file. Along a space-filling curve rows that
are near in *any* of the keys stay near: each key is replaced by its rank among the table's values (so that skewed and
textual keys spread evenly), the bits of the ranks are interleaved, and rows are range-partitioned by that number. With
two keys a value of either one lies in about the square root of all row groups, and the least and largest values that
Parquet keeps per row group rule out the others.

Ranks come from a range sketch: the values of ``SKETCH`` rows, those with the least hashes, cut into ``2 ** bits`` ranges.
The sketch has a fixed size, and it decides nothing but where rows lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = 16_384
BITS = 10


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema.fields])


def range_bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS, sketch: int = SKETCH) -> list[list]:
    """Per key at most ``2 ** bits - 1`` ascending values that cut its rows into ranges of about the same size."""
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    least = df.select(_row_hash(df).alias("h"), *named).orderBy("h", *[f"k{i}" for i in range(len(keys))]).limit(sketch)
    columns = [sorted(v for v in c if v is not None) for c in zip(*[r[1:] for r in least.collect()])] or [[] for _ in keys]
    parts = 1 << bits
    return [sorted({c[len(c) * i // parts] for i in range(1, parts)}) if c else [] for c in columns]


def _rank(key: Column, bounds: list, kind, bits: int) -> Column:
    """How many bounds are at or below the key, found bit by bit; 0 for null."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast(kind) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in range(bits - 1, -1, -1)])
    last = F.lit(len(bounds))
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= last) & (F.get(table, F.least(at + step, last) - 1) <= key), at + step).otherwise(at),
    )


def curve_position(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, highest first, as one number."""
    found = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            found = found * 2 + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return found


def along_curve(df: DataFrame, keys: Sequence[str], files: int | None = None, bits: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by their place on the curve through ``keys``.

    ``files`` partitions, or as many as adaptive execution finds fitting. Rows at one place (equal keys) are told
    apart by a hash of the row, so a combination that a third of the rows share is cut like any other.
    """
    if bits is None:
        bits = min(BITS, 60 // len(keys))
    kinds = [df.select(k).schema[0].dataType for k in keys]
    bounds = range_bounds(df, keys, bits)
    ranks = [F.col(f"_rank{i}") for i in range(len(keys))]
    ranked = df.withColumns({f"_rank{i}": _rank(F.col(k), b, kind, bits) for i, (k, b, kind) in enumerate(zip(keys, bounds, kinds))})
    placed = ranked.withColumn("_place", curve_position(ranks, bits)).withColumn("_tie", _row_hash(df))
    order = ["_place", "_tie"]
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return spread.sortWithinPartitions("_place", *keys).drop("_place", "_tie", *[f"_rank{i}" for i in range(len(keys))])
