"""The daily batch: land, format and integrate, each step once all steps before it are done."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import SparkSession

from riskmart import zones as z
from riskmart.plans import exploitation, formatting, landing
from riskmart.zones import Zones


def run(
    spark: SparkSession,
    zones: Zones,
    sources: Mapping[str, str],
    start_year: int,
    end_year: int,
    run_ts: datetime,
    allow_incomplete: bool = False,
) -> dict[str, dict[str, int]]:
    """Rows per dataset after each step. ``sources`` names the raw file or folder of each dataset.

    An incomplete download of awards ends the job before anything is written, unless allowed.
    Every step replaces what it writes (awards: only the years at hand), so a failed or repeated
    day is simply run again.
    """
    awards = landing.land_awards(
        spark, zones, sources[z.AWARDS], start_year, end_year, allow_incomplete=allow_incomplete
    )
    landed = {z.AWARDS: awards.rows}
    for dataset in (z.TERMINATED, z.REVIEW_LIST, z.LEXICON):
        landed[dataset] = landing.land_csv(spark, zones, dataset, sources[dataset])
    landed[z.LEGISLATORS] = landing.land_legislators(spark, zones, sources[z.LEGISLATORS])
    formatted = formatting.format_all(spark, zones, run_ts)
    rejected = formatting.rejected(spark, zones)
    return {"landed": landed, "formatted": formatted, "rejected": rejected, "integrated": exploitation.build_exploitation(spark, zones)}
