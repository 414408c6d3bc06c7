"""Landing zone to formatted zone: one lazy plan and one write per dataset."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart import zones as z
from riskmart.functions import cleaning
from riskmart.operators import columns, dedupe, lexicon, profile
from riskmart.sinks import writers
from riskmart.sources import readers, schemas
from riskmart.zones import Zones


def typed_awards(raw: DataFrame) -> DataFrame:
    """Canonical names, parsed dates and money, clean ids."""
    df = columns.with_canonical_names(raw, {"id": "award_id"})
    df = columns.parse_date_columns(df)
    return columns.apply_if_present(
        df,
        {
            "estimated_total_amt": ("estimatedtotalamt", cleaning.try_double),
            "funds_obligated_amt": ("fundsobligatedamt", cleaning.try_double),
            "award_id": ("award_id", cleaning.clean_id),
        },
    )


def clean_awards(raw: DataFrame) -> DataFrame:
    """Typed awards that have an id, the latest row of each."""
    df = typed_awards(raw)
    if "award_id" not in df.columns:
        return df
    latest = [c for c in ("date", "year") if c in df.columns]
    return dedupe.dedupe_latest(dedupe.split_rejects(df, award_rules())[0], ["award_id"], latest)


def award_rules() -> dict:
    """What an award must satisfy to be loaded, by the reason for rejecting it."""
    return {"missing award_id": F.col("award_id").isNotNull()}


def clean_terminated(raw: DataFrame) -> DataFrame:
    df = columns.parse_date_columns(columns.with_canonical_names(raw))
    return columns.apply_if_present(
        df,
        {
            "in_cruz_list": ("in_cruz_list", cleaning.bool_token),
            "usaspending_obligated": ("usaspending_obligated", cleaning.try_double),
            "grant_number": ("grant_number", cleaning.clean_id),
        },
    )


def clean_review_list(raw: DataFrame) -> DataFrame:
    df = columns.with_canonical_names(raw)
    df = columns.apply_if_present(
        df,
        {
            "award_id": ("award_id", cleaning.clean_id),
            "total_award_funding_amount": ("total_award_funding_amount", cleaning.try_double),
        },
    )
    return columns.null_token_columns(columns.parse_date_columns(df))


def clean_legislators(raw: DataFrame) -> DataFrame:
    return columns.with_canonical_names(raw)


def clean_lexicon(raw: DataFrame) -> DataFrame:
    df = columns.with_canonical_names(raw)
    return lexicon.normalize_lexicon(df) if "flagged_word" in df.columns else df


def _stamped(df: DataFrame, run_ts: datetime) -> DataFrame:
    return columns.stamp(columns.nan_to_null(df), run_ts)


def format_awards(spark: SparkSession, zones: Zones, run_ts: datetime, schema=schemas.LANDED_AWARD) -> int:
    raw = readers.read_json_lines(spark, zones.landing(z.AWARDS), schema)
    df = _stamped(clean_awards(raw), run_ts)
    bad = dedupe.split_rejects(typed_awards(raw), award_rules())[1]
    writers.replace_table(_stamped(bad, run_ts), zones.rejects("formatting", z.AWARDS))
    return writers.replace_keyed_table(df, zones.formatted(z.AWARDS), ["award_id"], "year")


def format_terminated(spark: SparkSession, zones: Zones, run_ts: datetime) -> int:
    df = _stamped(clean_terminated(readers.read_table(spark, zones.landing(z.TERMINATED))), run_ts)
    return writers.replace_keyed_table(df, zones.formatted(z.TERMINATED), ["grant_number", "in_cruz_list"])


def format_review_list(spark: SparkSession, zones: Zones, run_ts: datetime) -> int:
    df = _stamped(clean_review_list(readers.read_table(spark, zones.landing(z.REVIEW_LIST))), run_ts)
    return writers.replace_keyed_table(df, zones.formatted(z.REVIEW_LIST), ["award_id"])


def format_legislators(spark: SparkSession, zones: Zones, run_ts: datetime) -> int:
    df = _stamped(clean_legislators(readers.read_table(spark, zones.landing(z.LEGISLATORS))), run_ts)
    return writers.replace_keyed_table(df, zones.formatted(z.LEGISLATORS), "id.bioguide")


def format_lexicon(spark: SparkSession, zones: Zones, run_ts: datetime) -> int:
    df = _stamped(clean_lexicon(readers.read_table(spark, zones.landing(z.LEXICON))), run_ts)
    return writers.replace_keyed_table(df, zones.formatted(z.LEXICON), "flagged_word")


_FORMATTERS = {
    z.AWARDS: format_awards,
    z.TERMINATED: format_terminated,
    z.REVIEW_LIST: format_review_list,
    z.LEGISLATORS: format_legislators,
    z.LEXICON: format_lexicon,
}


def format_all(spark: SparkSession, zones: Zones, run_ts: datetime) -> dict[str, int]:
    """Format every dataset; rows written per dataset."""
    return {name: run(spark, zones, run_ts) for name, run in _FORMATTERS.items()}


def validate_formatted(spark: SparkSession, zones: Zones) -> DataFrame:
    """Counts and leading fields of the formatted tables, with the grand total."""
    tables = {name: readers.read_optional(spark, zones.formatted(name)) for name in z.DATASETS}
    return profile.zone_validation({name: df for name, df in tables.items() if df is not None})


def duplicates_removed(spark: SparkSession, zones: Zones) -> DataFrame:
    """Rows before and after the award dedupe."""
    landed = readers.read_json_lines(spark, zones.landing(z.AWARDS), schemas.LANDED_AWARD)
    raw = columns.with_canonical_names(landed, {"id": "award_id"})
    keys = columns.require(raw.select(cleaning.clean_id(F.col("award_id")).alias("award_id")), ["award_id"])
    return dedupe.dedupe_report(keys, ["award_id"])


def rejected(spark: SparkSession, zones: Zones) -> dict[str, int]:
    """Rows per dataset that landing and formatting set aside; the tables hold them with their reasons."""
    found: dict[str, int] = {}
    for step in ("landing", "formatting"):
        for name in z.DATASETS:
            table = readers.read_optional(spark, zones.rejects(step, name))
            if table is not None:
                found[name] = found.get(name, 0) + table.count()
    return found
