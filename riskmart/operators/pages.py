"""Paged feeds: what is in their pages, and whether all pages are there."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ROWS_PER_PAGE = 25


def explode_envelope(
    pages: DataFrame,
    envelope: str = "response",
    items: str = "award",
    keep: tuple[str, ...] = (),
    known: tuple[str, ...] = (),
    extra: str = "extra",
) -> DataFrame:
    """Rows of the page envelopes; an envelope with a service notification or no items gives none.

    Items read as maps keep every field: the ``known`` names become columns, all others stay
    together in the map ``extra``.
    """
    kind = pages.schema[envelope].dataType
    good = pages.filter(F.col(f"{envelope}.serviceNotification").isNull()) if "serviceNotification" in kind.fieldNames() else pages
    rows = good.select(*keep, F.explode(f"{envelope}.{items}").alias("_item"))
    if not isinstance(kind[items].dataType.elementType, T.MapType):
        return rows.select(*keep, "_item.*")
    named = [F.col("_item")[name].alias(name) for name in known]
    rest = F.map_filter("_item", lambda name, _: ~name.isin(*known)) if known else F.col("_item")
    return rows.select(*keep, *named, rest.alias(extra))


def readable_pages(pages: DataFrame, failed: str = "failed") -> DataFrame:
    """Every page that could be read, whatever is missing around it."""
    return pages.filter(~F.col(failed))


def page_audit(
    pages: DataFrame,
    feed: str,
    offset: str,
    n_rows: str,
    failed: str,
    rpp: int = DEFAULT_ROWS_PER_PAGE,
    expected: Iterable | None = None,
) -> DataFrame:
    """Completeness of each feed, over its distinct offsets.

    An offset counts as failed when no copy of its page could be read. A feed is complete when its
    offsets are all on the grid and none is missing, duplicated or failed, and only its last page
    is short. Feeds that are ``expected`` and have no page at all are listed and incomplete.
    """
    by_offset = pages.groupBy(feed, offset).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.bool_and(failed).alias("_failed"),
        F.max(F.when(~F.col(failed), F.col(n_rows))).alias("_rows"),
        F.sum(F.when(~F.col(failed), F.col(n_rows)).otherwise(0)).alias("_all"),
    )
    aligned = F.col(offset) % rpp == 0
    short = ~F.col("_failed") & (F.col("_rows") < rpp)
    found = by_offset.groupBy(feed).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("_all").alias("n_rows"),
        F.max(F.when(aligned, F.col(offset))).alias("last_offset"),
        F.count_if("_failed").alias("failed_pages"),
        F.sum(F.col("_copies") - 1).alias("duplicate_pages"),
        F.count_if(~F.coalesce(aligned, F.lit(False))).alias("misaligned_pages"),
        F.count_if(aligned).alias("_aligned"),
        F.count_if(short).alias("_short"),
        F.max_by(F.coalesce(short, F.lit(False)), offset).alias("ends_short"),
    )
    if expected is not None:
        wanted = pages.sparkSession.createDataFrame([(f,) for f in expected], T.StructType([T.StructField(feed, pages.schema[feed].dataType)]))
        found = found.join(wanted, feed, "full")
    counts = ("n_pages", "n_rows", "failed_pages", "duplicate_pages", "misaligned_pages", "_aligned", "_short")
    filled = found.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts}).withColumn(
        "ends_short", F.coalesce("ends_short", F.lit(False))
    )
    return (
        filled.withColumn("missing_pages", F.coalesce(F.floor(F.col("last_offset") / rpp) + 1 - F.col("_aligned"), F.lit(0)))
        .withColumn("early_short_pages", F.col("_short") - F.col("ends_short").cast("int"))
        .withColumn(
            "complete",
            F.col("ends_short") & (F.col("early_short_pages") == 0) & (F.col("missing_pages") == 0)
            & (F.col("failed_pages") == 0) & (F.col("duplicate_pages") == 0) & (F.col("misaligned_pages") == 0),
        )
        .drop("_short", "_aligned")
    )
