"""Raw files to the landing zone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import zones as z
from riskmart.operators import dedupe
from riskmart.operators import pages as paging
from riskmart.sinks import writers
from riskmart.sources import readers, schemas
from riskmart.zones import Zones


class IncompleteDownload(ValueError):
    """Pages or whole years are missing; ``audit`` holds one row per year."""

    def __init__(self, audit: list):
        super().__init__(f"incomplete years: {[r['year'] for r in audit if not r['complete']]}")
        self.audit = audit


@dataclass(frozen=True)
class LandedAwards:
    rows: int
    audit: list  # one row per requested year


def audit_awards(
    spark: SparkSession, source: str, rpp: int = paging.DEFAULT_ROWS_PER_PAGE, years: range | None = None
) -> DataFrame:
    """Completeness of the downloaded pages per year; years asked for without any page are listed."""
    pages = readers.read_pages(spark, source)
    if years is not None:
        pages = pages.filter(F.col("year").between(years.start, years.stop - 1))
    return paging.page_audit(pages, "year", "offset", "n_rows", "failed", rpp, years)


def awards_of(pages: DataFrame) -> DataFrame:
    """All awards, with all their fields, of every page that can be read."""
    good = paging.readable_pages(pages)
    return paging.explode_envelope(good, keep=("year",), known=schemas.AWARD_FIELDS, extra=schemas.EXTRA)


def land_awards(
    spark: SparkSession,
    zones: Zones,
    source: str,
    start_year: int,
    end_year: int,
    rpp: int = paging.DEFAULT_ROWS_PER_PAGE,
    overwrite: bool = True,
    allow_incomplete: bool = False,
) -> LandedAwards:
    """Land every readable page of the years; nothing that is there is left out.

    The audit comes first: if a year has missing, failed, duplicate or misplaced pages, or no page
    at all, nothing is written and :class:`IncompleteDownload` says which, unless incomplete years
    are allowed. Overwriting replaces the requested years, empty ones too, and leaves others alone.
    """
    if end_year < start_year:
        raise ValueError("end_year must not be before start_year")
    years = range(start_year, end_year + 1)
    audit = audit_awards(spark, source, rpp, years).orderBy("year").collect()  # a row per year
    if not allow_incomplete and not all(r["complete"] for r in audit):
        raise IncompleteDownload(audit)
    awards = awards_of(readers.read_pages(spark, source).filter(F.col("year").between(start_year, end_year)))
    path = zones.landing(z.AWARDS)
    writers.write_json_partitions(awards, path, "year", overwrite)
    if overwrite:  # after the new rows are safe: a failed write clears nothing
        writers.clear_json_partitions(spark, path, "year", [r["year"] for r in audit if not r["n_rows"]])
    landed = readers.read_json_lines(spark, path, schemas.LANDED_AWARD)
    return LandedAwards(landed.filter(F.col("year").between(start_year, end_year)).count(), audit)


def land_csv(spark: SparkSession, zones: Zones, dataset: str, source: str) -> int:
    """A flat list (terminated, review list, lexicon) as Parquet; malformed records go to the reject table."""
    raw = readers.read_csv(spark, source, multi_line=True)
    rules = {"malformed record": F.col(schemas.CORRUPT).isNull()}
    good, bad = dedupe.split_rejects(raw, rules)
    writers.replace_table(bad, zones.rejects("landing", dataset))
    return writers.replace_table(good.drop(schemas.CORRUPT), zones.landing(dataset))


def land_legislators(spark: SparkSession, zones: Zones, source: str) -> int:
    people = readers.read_json_array(spark, source, schemas.LEGISLATOR)
    return writers.replace_table(people, zones.landing(z.LEGISLATORS))
