"""Zone counts and column profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.dedupe import union_all

TOTAL = "TOTAL"

_LOGICAL = (
    (T.StringType, "string"),
    (T.BooleanType, "bool"),
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "int"),
    ((T.FloatType, T.DoubleType, T.DecimalType), "float"),
    ((T.TimestampType, T.TimestampNTZType), "datetime"),
    (T.DateType, "date"),
    ((T.StructType, T.MapType), "dict"),
)


def first_fields(df: DataFrame, k: int = 10) -> list[str]:
    return df.columns[:k]


def zone_validation(tables: Mapping[str, DataFrame], fields: int = 10) -> DataFrame:
    """Rows, columns and leading field names per dataset, and a grand-total row."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.lit(", ".join(first_fields(df, fields))).alias("leading_fields"),
        )
        for name, df in tables.items()
    ]
    return (
        union_all(counts)
        .rollup("dataset")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_columns").alias("n_columns"),
            F.when(F.grouping("dataset") == 0, F.max("leading_fields")).alias("leading_fields"),
        )
        .withColumn("dataset", F.coalesce("dataset", F.lit(TOTAL)))
    )


def logical_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.ArrayType):
        return f"list[{logical_type(dtype.elementType)}]"
    for classes, name in _LOGICAL:
        if isinstance(dtype, classes):
            return name
    return dtype.simpleString()


def column_profile(df: DataFrame) -> DataFrame:
    """Position, logical type and filled rows per column; a column without a value is ``empty / null``.

    One aggregation of plain counts: no shuffle beyond one partial row per task.
    """
    filled = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(logical_type(f.dataType)).alias("declared"),
                    F.count(F.col(f"`{f.name}`")).alias("n_filled"),
                )
                for i, f in enumerate(df.schema.fields, 1)
            ]
        ).alias("profiles"),
    )
    return filled.select("n_rows", F.explode("profiles").alias("p")).select(
        "p.position",
        "p.column_name",
        F.when(F.col("p.n_filled") == 0, "empty / null").otherwise(F.col("p.declared")).alias("logical_type"),
        "n_rows",
        "p.n_filled",
    )


def rows_per(df: DataFrame, *by: str) -> DataFrame:
    """Load summary: rows per value of ``by``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


HLL_BITS = 14  # distinct counts: exact while small, then within about 2 % (three standard errors)
QUANTILES = (0.25, 0.5, 0.75)


def profile_sketches(df: DataFrame, by: str) -> DataFrame:
    """Mergeable profile: per value of ``by`` and column its rows, filled rows, and sketches of distinct values and quantiles.

    One pass; a sketch has a bounded size whatever the rows. Stored, they let a new year cost one pass over that year:
    :func:`merged_profile` adds it to the others. Nested values count as their JSON text; quantiles are of numbers that
    are not NaN, null for other types.
    """
    def sketched(f: T.StructField):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, (T.IntegralType, T.FractionalType))
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        text = F.when(c.isNotNull(), F.to_json(F.struct(c))) if nested else c.cast("string")
        value = c.cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count(c).alias("n_filled"),
            F.hll_sketch_agg(text, HLL_BITS).alias("distinct"),
            F.kll_sketch_agg_double(F.when(~F.isnan(value), value)).alias("quantiles"),
        )

    fields = [f for f in df.schema.fields if f.name != by]
    made = df.groupBy(by).agg(F.array(*map(sketched, fields)).alias("_columns"))
    return made.select(by, F.inline("_columns"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """``column_name, n_rows, n_filled, n_distinct`` and the quartiles, from stored sketches of any number of parts."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_filled").alias("n_filled"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.filter(F.collect_list("quantiles"), lambda q: F.kll_sketch_get_n_double(q) > 0).alias("_parts"),  # one per part
    )
    whole = F.aggregate(
        F.slice("_parts", F.lit(2), F.greatest(F.size("_parts") - 1, F.lit(0))), F.get("_parts", F.lit(0)),
        lambda a, b: F.kll_sketch_merge_double(a, b),
    )
    return merged.withColumn("_whole", whole).select(
        "column_name", "n_rows", "n_filled", "n_distinct",
        *[F.when(F.col("_whole").isNotNull(), F.kll_sketch_get_quantile_double("_whole", F.lit(q))).alias(f"p{round(q * 100)}") for q in QUANTILES],
    )
