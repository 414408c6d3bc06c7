"""Cleaning expressions for dates, money, identifiers, tokens and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that count as true, false and null in the raw files.
TRUE_TOKENS = ("True", "true", "1", "yes")
FALSE_TOKENS = ("False", "false", "0", "no", "", "None", "NULL", "null")
NULL_TOKENS = ("", "NULL", "null", "None")
DEFAULT_LABEL = "Unknown"


def parse_date(c: Column) -> Column:
    """Timestamp from ``MM/dd/yyyy``, ``yyyy-MM-dd``, ISO ``T`` or anything a cast accepts.

    The cast already reads both ISO shapes, so only strings holding a slash pay for the
    formatter. A zone id such as ``Europe/Paris`` also holds a slash, hence the fallback.
    """
    slashed = F.when(F.contains(c, F.lit("/")), F.try_to_timestamp(c, F.lit("MM/dd/yyyy")))
    return F.coalesce(slashed, F.try_to_timestamp(c))


def try_double(c: Column) -> Column:
    return c.try_cast("double")


def try_int(c: Column) -> Column:
    return c.try_cast("int")


def clean_id(c: Column) -> Column:
    """Text identifier without the ``.0`` that a numeric reader leaves behind."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def reconcile_key(c: Column) -> Column:
    """Identifier comparable across files: ``.0`` and the zero padding of all-digit ids removed."""
    return F.regexp_replace(clean_id(c), r"^0+(\d+)$", "$1")


def bool_token(c: Column) -> Column:
    """Three-valued flag: known spellings map to true or false, the rest (and null) to null."""
    text = c.cast("string")
    return F.when(text.isin(*TRUE_TOKENS), F.lit(True)).when(text.isin(*FALSE_TOKENS), F.lit(False))


def null_token(c: Column) -> Column:
    """Null for blank or null-like text, otherwise the value as it came (not trimmed)."""
    return F.when(~F.trim(c).isin(*NULL_TOKENS), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normalize_word(c: Column) -> Column:
    """Lower-case entry of a word list: white space of any kind around it goes, inside it is one space."""
    return F.lower(F.trim(F.regexp_replace(c, r"[\p{Z}\s]+", " ")))


def flag_to_int(c: Column) -> Column:
    """1 for true, 0 for false and for null."""
    return F.coalesce(c.cast("int"), F.lit(0))


def text_or_default(c: Column, default: str = DEFAULT_LABEL) -> Column:
    """``default`` for null and for the empty string."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def json_field(c: Column, name: str, kind: str = "string", default: object = None) -> Column:
    """A top-level field of a JSON text in the type wanted; ``default`` where it is absent, null or of another type."""
    value = F.from_json(c, f"`{name}` {kind}")[name]
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))
