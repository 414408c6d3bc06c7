"""Explicit schemas of the nested raw datasets. Flat files are read as text and typed by name."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of an award in a page envelope.
AWARD_FIELDS = (
    "id", "agency", "awardAgencyCode", "dirAbbr", "divAbbr", "fundAgencyCode", "fundProgramName",
    "orgLongName", "orgCodeDir", "orgCodeDiv", "orgUrl", "perfCity", "perfStateCode", "perfCountryCode",
    "perfZipCode", "estimatedTotalAmt", "fundsObligatedAmt", "startDate", "date", "expDate",
    "projectOutComesReport", "title", "transType", "abstract", "abstractText",
)

# Fields that are not listed above; nested values as JSON text.
EXTRA = "extra"

# A landed award: the listed fields, and every other one in a map.
AWARD = T.StructType(
    [*[T.StructField(name, T.StringType()) for name in AWARD_FIELDS], T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType()))]
)
LANDED_AWARD = T.StructType([*AWARD.fields, T.StructField("year", T.IntegerType())])

ENVELOPE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("award", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
                    T.StructField("serviceNotification", T.StringType()),
                ]
            ),
        )
    ]
)

TERM = T.StructType([T.StructField(name, T.StringType()) for name in ("type", "state", "start", "end", "party")])

LEGISLATOR = T.StructType(
    [
        T.StructField("id", T.StructType([T.StructField("bioguide", T.StringType())])),
        T.StructField("terms", T.ArrayType(TERM)),
    ]
)

RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_name", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that takes unreadable records."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
