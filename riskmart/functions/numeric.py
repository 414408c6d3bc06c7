"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Double quotient; 0 where the denominator is 0 or either side is null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def log_shifted(c: Column) -> Column:
    """``ln(x + 1)``; null where ``x <= -1``."""
    return F.log(c + F.lit(1.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio_or_zero(part * F.lit(100.0), whole), digits)


def key_digest(key: Column, salt: str) -> Column:
    """Salted MD5 of a key, as 32 hexadecimal digits; a null key counts as empty text."""
    return F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))


def hash_fraction(key: Column, salt: str) -> Column:
    """Reproducible number in [0, 1) from a key: the first 32 bits of a salted MD5.

    Depends on nothing but the key and the salt, so it is the same under any partitioning,
    file order or retry.
    """
    return F.conv(F.substring(key_digest(key, salt), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def class_probability(vector: str, cls: int = 1) -> Column:
    """Probability of a class from a probability vector; 0.0 if the model does not know the class."""
    return F.coalesce(F.get(vector_to_array(vector), F.lit(cls)), F.lit(0.0))
