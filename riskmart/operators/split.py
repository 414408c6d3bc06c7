"""Reproducible row splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.functions.numeric import hash_fraction, key_digest
from riskmart.operators.joins import lookup_join

PREFIX = 4  # hexadecimal digits of a digest that make a histogram bucket


def hash_split(
    df: DataFrame,
    key: str,
    first_ratio: float = 0.8,
    seed: int = 42,
    names: tuple[str, str] = ("train", "test"),
    column: str = "split",
    level: str = "outer",
) -> DataFrame:
    """Assign each row to one of two named parts by the hash of its key.

    A narrow projection: no shuffle, and the same rows land in the same part however the
    input is partitioned. ``level`` salts the hash, so a nested split is independent of the
    outer one.
    """
    if not 0.0 <= first_ratio <= 1.0:
        raise ValueError("first_ratio must lie in [0, 1]")
    fraction = hash_fraction(F.col(key), f"{level}:{seed}:")
    return df.withColumn(column, F.when(fraction < first_ratio, names[0]).otherwise(names[1]))


def hash_folds(df: DataFrame, key: str, folds: int, seed: int = 42, column: str = "fold") -> DataFrame:
    """Fold number per row for cross-validation, from the key alone."""
    return df.withColumn(column, F.floor(hash_fraction(F.col(key), f"fold:{seed}:") * folds).cast("int"))


def _strata(df: DataFrame, key: str, by: Sequence[str], salt: str) -> tuple[Column, Column]:
    """A row's class as one text that is never null, and its place in the class: the digest of its key."""
    return F.to_json(F.struct(*by)), key_digest(F.col(key), salt)


def stratum_cuts(df: DataFrame, key: str, by: Sequence[str], first_ratio: float, salt: str) -> DataFrame:
    """(_stratum, _cut): per class the digest of the ``round(first_ratio * n)``-th row in digest order.

    A distributed selection without a sort of the rows. A histogram of digest prefixes, summed where the rows
    are read, tells in which bucket the wanted row lies and how many rows come before it; only that bucket's
    digests (one in ``16 ** PREFIX`` of the class) are then ranked. A class that none of the first part is taken
    from has an empty cut.
    """
    stratum, digest = _strata(df, key, by, salt)
    rows = df.select(stratum.alias("_stratum"), digest.alias("_digest"))
    sizes = rows.groupBy("_stratum", F.left("_digest", F.lit(PREFIX)).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_stratum")
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.floor(F.sum("_n").over(whole) * F.lit(first_ratio) + 0.5)
    located = sizes.select("_stratum", "_bucket", (wanted - (F.sum("_n").over(upto) - F.col("_n"))).alias("_rest"), "_n")
    # One row per class: the bucket that is cut, and how many of its rows belong to the first part.
    cut = located.filter("_rest > 0 AND _rest <= _n").select("_stratum", "_bucket", "_rest")
    inside = lookup_join(rows.withColumn("_bucket", F.left("_digest", F.lit(PREFIX))), cut, ["_stratum", "_bucket"], "inner")
    nth = F.row_number().over(Window.partitionBy("_stratum").orderBy("_digest"))
    return inside.withColumn("_nth", nth).filter("_nth = _rest").select("_stratum", F.col("_digest").alias("_cut"))


def stratified_split(
    df: DataFrame,
    key: str,
    by: str | Sequence[str],
    first_ratio: float = 0.8,
    seed: int = 42,
    names: tuple[str, str] = ("train", "test"),
    column: str = "split",
    level: str = "outer",
) -> DataFrame:
    """Like :func:`hash_split`, with the exact share of every class of ``by`` in the first part.

    Of a class with ``n`` rows the ``round(first_ratio * n)`` with the least digests of their keys come first;
    a null class is a class. Rows are not shuffled (the cuts are one row per class) and the parts are the same
    under any partitioning. Rows that repeat a key within a class stay together, so there the share is exact
    up to the repeats of one key.
    """
    if not 0.0 <= first_ratio <= 1.0:
        raise ValueError("first_ratio must lie in [0, 1]")
    by = [by] if isinstance(by, str) else list(by)
    salt = f"{level}:{seed}:"
    stratum, digest = _strata(df, key, by, salt)
    cuts = stratum_cuts(df, key, by, first_ratio, salt)
    cut = lookup_join(df.withColumn("_stratum", stratum), cuts, ["_stratum"], "left")
    first = F.coalesce(digest <= F.col("_cut"), F.lit(False))
    return cut.withColumn(column, F.when(first, names[0]).otherwise(names[1])).drop("_stratum", "_cut")
