"""Model features and class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.cleaning import flag_to_int
from riskmart.functions.numeric import log_shifted, percent, ratio_or_null

_FEATURE_TYPES = (T.DoubleType, T.IntegerType, T.LongType, T.FloatType)


def funding_features(df: DataFrame, funds: str = "funds_obligated_amt", total: str = "estimated_total_amt") -> DataFrame:
    """Ratio, difference and efficiency of funded to planned money; skipped if a column is missing."""
    if funds not in df.columns or total not in df.columns:
        return df
    ratio = ratio_or_null(F.col(funds), F.col(total) + 1)
    return df.withColumns(
        {
            "funding_ratio": ratio,
            "funding_difference": F.col(total) - F.col(funds),
            "funding_efficiency": ratio * 100,
        }
    )


def log_features(df: DataFrame, funds: str = "funds_obligated_amt", total: str = "estimated_total_amt") -> DataFrame:
    wanted = {"log_funds_obligated": funds, "log_estimated_total": total}
    return df.withColumns({out: log_shifted(F.col(src)) for out, src in wanted.items() if src in df.columns})


def bool_to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Boolean columns of the list as 0/1; other types and absent names are left alone."""
    flags = {
        f.name: flag_to_int(F.col(f.name))
        for f in df.schema.fields
        if f.name in columns and isinstance(f.dataType, T.BooleanType)
    }
    return df.withColumns(flags) if flags else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _FEATURE_TYPES)]


def feature_columns(df: DataFrame, target: str, drop: Sequence[str] = ()) -> list[str]:
    return [c for c in numeric_columns(df) if c != target and c not in drop]


def feature_groups(names: Sequence[str]) -> dict[str, list[str]]:
    """Text features and engineered features, told apart by name."""
    marks = ("ratio", "log_", "difference", "efficiency")
    return {
        "flagged": [n for n in names if "flagged" in n.lower()],
        "engineered": [n for n in names if any(m in n for m in marks)],
    }


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with neither null nor NaN in the numeric columns."""
    return df.dropna(how="any", subset=list(columns) if columns else numeric_columns(df))


def completeness_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that :func:`complete_cases` keeps and drops, and per numeric column how many lack a value."""
    wanted = list(columns) if columns else numeric_columns(df)
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def missing(name: str):
        c = F.col(name)
        return c.isNull() | F.isnan(c) if name in floats else c.isNull()

    incomplete = F.greatest(F.lit(False), F.lit(False), *[missing(n) for n in wanted])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~incomplete).alias("n_complete"),
        F.count_if(incomplete).alias("n_dropped"),
        *[F.count_if(missing(n)).alias(f"missing_{n}") for n in wanted],
    )


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows and percent per class. The total is summed from the class counts, not from the rows."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", percent(F.col("n_rows"), total))


def class_weights(df: DataFrame, target: str, name: str = "sample_weight") -> DataFrame:
    """Balanced weight ``N / (2 * n_class)`` for classes 0 and 1, 1.0 for any other label.

    The three counts come from one single-row scalar subquery: the rows themselves are never
    shuffled by their (two, hence hot) class values, and a missing class cannot fail.
    """
    is_neg, is_pos = F.col(target) == 0, F.col(target) == 1
    counts = df.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(is_neg).alias("n0"),
            F.count_if(is_pos).alias("n1"),
        ).alias("c")
    ).scalar()
    n = counts["n"].cast("double")
    return df.withColumn(
        name,
        F.when(is_neg, F.try_divide(n, 2.0 * counts["n0"]))
        .when(is_pos, F.try_divide(n, 2.0 * counts["n1"]))
        .otherwise(F.lit(1.0)),
    )
