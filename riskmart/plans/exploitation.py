"""Formatted zone to the wide, labelled train and test table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart import zones as z
from riskmart.functions import cleaning
from riskmart.operators import columns, intervals, lexicon, membership, split
from riskmart.sinks import writers
from riskmart.sources import readers
from riskmart.zones import Zones

# Term types and the columns they fill.
KINDS = {"rep": "representant", "sen": "senator"}


def _flagged(fact: DataFrame, listed: DataFrame | None, key: str, flag: str) -> DataFrame:
    if listed is None or key not in listed.columns:
        return fact.withColumn(flag, F.lit(False))
    return membership.membership_flag(fact, listed, "award_id", key, flag)


def _with_parties(fact: DataFrame, legislators: DataFrame | None) -> DataFrame:
    if legislators is None or "terms" not in legislators.columns or "perfstatecode" not in fact.columns:
        return fact.withColumns({out: F.lit(cleaning.DEFAULT_LABEL) for out in KINDS.values()})
    terms = intervals.explode_terms(legislators)
    return intervals.interval_lookup(fact, terms, "perfstatecode", "startdate_dt", KINDS)


def _with_text_features(fact: DataFrame, words: DataFrame | None, abstract: str, phrases: bool) -> DataFrame:
    if words is None or "flagged_word" not in words.columns:
        return lexicon.lexicon_features(fact, [], abstract)
    inline = lexicon.small_lexicon(words)
    if inline is not None:
        return lexicon.lexicon_features(fact, inline, abstract, phrases=phrases)
    return lexicon.lexicon_features_by_join(fact, words, abstract, phrases=phrases)


def exploitation_frame(
    awards: DataFrame,
    terminated: DataFrame | None = None,
    review_list: DataFrame | None = None,
    legislators: DataFrame | None = None,
    words: DataFrame | None = None,
    phrases: bool = False,
) -> DataFrame:
    """Flags, label, parties and text features beside the award columns.

    The abstract is carried through the text features and then dropped: it is not a column of
    the wide table. Columns that depend on an absent dataset are present with their empty value.
    """
    fact = columns.require(awards, ["year", "award_id"])
    fact = _flagged(fact, review_list, "award_id", "in_cruz_list")
    fact = _flagged(fact, terminated, "grant_number", "is_terminated")
    if "startdate" in fact.columns:
        text = isinstance(fact.schema["startdate"].dataType, T.StringType)
        parsed = cleaning.parse_date(F.col("startdate")) if text else F.col("startdate").cast("timestamp")
    else:
        parsed = F.lit(None).cast("timestamp")
    fact = _with_parties(fact.withColumn("startdate_dt", parsed), legislators)
    # Feeds name the abstract in one of two ways; a row may have either.
    abstract = "abstract" if "abstract" in fact.columns else "abstracttext"
    if {"abstract", "abstracttext"} <= set(fact.columns):
        fact = fact.withColumn("abstract", F.coalesce("abstract", "abstracttext"))
    fact = _with_text_features(fact, words, abstract, phrases)
    fact = columns.apply_if_present(
        fact,
        {
            "year": ("year", cleaning.try_int),
            "estimated_total_amt": ("estimated_total_amt", cleaning.try_double),
            "funds_obligated_amt": ("funds_obligated_amt", cleaning.try_double),
        },
    )
    extra = ("startdate_dt", *KINDS.values(), *lexicon.FEATURES)
    return columns.select_existing(columns.require(fact, ["year"]), (*columns.CANDIDATE_COLUMNS, *extra))


def build_exploitation(
    spark: SparkSession, zones: Zones, train_ratio: float = 0.8, seed: int = 42, phrases: bool = False
) -> dict[str, int]:
    """Write train and test in one pass, below ``split=.../year=...``; rows per part.

    The parent plan runs once: the split is a column of the rows, not two filtered writes.
    """
    awards = readers.read_required(spark, zones.formatted(z.AWARDS))
    others = {
        "terminated": z.TERMINATED, "review_list": z.REVIEW_LIST, "legislators": z.LEGISLATORS, "words": z.LEXICON,
    }
    tables = {arg: readers.read_optional(spark, zones.formatted(name)) for arg, name in others.items()}
    frame = exploitation_frame(awards, phrases=phrases, **tables)
    parted = split.hash_split(frame, "award_id", train_ratio, seed)
    by = [c for c in ("split", "year") if c in parted.columns]
    writers.write_partitioned(parted, zones.exploitation, by, zones.fmt)
    written = spark.read.format(zones.fmt).load(zones.exploitation).groupBy("split").count()
    return {r["split"]: r["count"] for r in written.collect()}
