"""Column naming, selection and name-driven cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions import cleaning

# Columns of the wide table, in output order.
CANDIDATE_COLUMNS = (
    "award_id", "year", "agency", "awardagencycode", "dirabbr", "divabbr", "fundagencycode",
    "fundprogramname", "orglongname", "orgcodedir", "orgcodediv", "orgurl", "perfcity",
    "perfstatecode", "perfcountrycode", "perfzipcode", "estimated_total_amt",
    "funds_obligated_amt", "startdate", "date", "expdate", "projectoutcomesreport", "title",
    "transtype", "formatted_at", "in_cruz_list", "is_terminated",
)

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def canonical_name(name: str) -> str:
    """Lower-case identifier: every other character is a separator, runs of them collapse."""
    spaced = "".join(ch if ch.isalnum() else " " for ch in name.lower())
    return "_".join(spaced.split())


def canonical_names(names: Sequence[str], renames: Mapping[str, str] | None = None) -> list[str]:
    """Canonical, renamed and unique: a clash takes the next free ``_2``, ``_3`` ... suffix.

    A column that has the business name already keeps it; one that is renamed to it comes second.
    """
    plain = [canonical_name(n) or f"column_{i}" for i, n in enumerate(names, 1)]
    bases = [(renames or {}).get(b, b) for b in plain]
    order = sorted(range(len(bases)), key=lambda i: (bases[i] != plain[i], i))
    unique = dict(zip(order, _unique([bases[i] for i in order])))
    return [unique[i] for i in range(len(bases))]


def _unique(bases: Sequence[str]) -> list[str]:
    reserved, taken, out = set(bases), set(), []
    for base in bases:
        name, n = base, 1
        while name in taken or (n > 1 and name in reserved):
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out.append(name)
    return out


def with_canonical_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every column by position, business renames such as ``id -> award_id`` included."""
    return df.toDF(*canonical_names(df.columns, renames))


def columns_like(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c.lower()]


def parse_date_columns(df: DataFrame, part: str = "date") -> DataFrame:
    """Parse text columns named like a date; temporal ones become timestamps, others stay."""
    parsed: dict[str, Column] = {}
    for field in df.schema.fields:
        if part not in field.name.lower():
            continue
        if isinstance(field.dataType, T.StringType):
            parsed[field.name] = cleaning.parse_date(F.col(field.name))
        elif isinstance(field.dataType, _TEMPORAL):
            parsed[field.name] = F.col(field.name).cast("timestamp")
    return df.withColumns(parsed) if parsed else df


def null_token_columns(df: DataFrame, part: str = "category") -> DataFrame:
    """Blank out null-like text in the string columns named like ``part``."""
    cleaned = {
        f.name: cleaning.null_token(F.col(f.name))
        for f in df.schema.fields
        if part in f.name.lower() and isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(cleaned) if cleaned else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column; nested columns stay untouched."""
    floats = {
        f.name: cleaning.nan_to_null(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def apply_if_present(df: DataFrame, rules: Mapping[str, tuple[str, object]]) -> DataFrame:
    """``{output: (input, column function)}`` for the inputs that exist; the rest is skipped."""
    present = {out: fn(F.col(src)) for out, (src, fn) in rules.items() if src in df.columns}
    return df.withColumns(present) if present else df


def select_existing(df: DataFrame, candidates: Sequence[str] = CANDIDATE_COLUMNS) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in candidates if c in have])


def require(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns (those that exist) are all set."""
    have = [k for k in keys if k in df.columns]
    return df.dropna(subset=have) if have else df


def stamp(df: DataFrame, run_ts: datetime, name: str = "formatted_at") -> DataFrame:
    """Load time passed in by the caller, so that a re-run writes the same rows."""
    return df.withColumn(name, F.lit(run_ts))


def year_range(df: DataFrame, date: str, start_year: int, end_year: int, year: str = "year") -> DataFrame:
    """Rows dated within whole years, with the year as partition column.

    The bounds are typed literals against the bare column, so the range reaches the scan.
    """
    if end_year < start_year:
        raise ValueError("end_year must not be before start_year")
    typed = df.schema[date].dataType.simpleString()
    low = F.lit(f"{start_year:04d}-01-01").cast(typed)
    high = F.lit(f"{end_year + 1:04d}-01-01").cast(typed)
    return df.filter((F.col(date) >= low) & (F.col(date) < high)).withColumn(year, F.year(date))


def year_bounds(year: Column) -> tuple[Column, Column]:
    """First and last day of a year as ``MM/dd/yyyy`` text, the request format of paged feeds."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    last = F.make_date(year, F.lit(12), F.lit(31))
    return F.date_format(first, "MM/dd/yyyy"), F.date_format(last, "MM/dd/yyyy")
