from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import rows
from riskmart.operators import intervals

KINDS = {"rep": "representant", "sen": "senator"}
TERMS = "type string, state string, start timestamp, end timestamp, party string"


def brute_force(facts, terms):
    out = []
    for i, state, when in facts:
        found = []
        for kind in KINDS:
            covering = [
                (s, e, p or "") for k, st, s, e, p in terms
                if k == kind and st == state and state is not None and when is not None and s <= when <= e
            ]
            found.append((max(covering)[2] if covering else "") or "Unknown")
        out.append((i, *found))
    return sorted(out, key=repr)


def lookup(spark, facts, terms, **options):
    fact = spark.createDataFrame(facts, "i int, state string, day timestamp")
    found = intervals.interval_lookup(fact, spark.createDataFrame(terms, TERMS), "state", "day", KINDS, **options)
    return rows(found, "i", *KINDS.values())


def d(text):
    return datetime.fromisoformat(text)


def test_edges(spark):
    terms = [
        ("rep", "MA", d("2020-01-03"), d("2022-01-03"), "A"),
        ("rep", "MA", d("2022-01-03"), d("2024-01-03"), "B"),
        ("rep", "MA", d("2023-01-01"), d("2023-02-01"), "C"),
        ("rep", "MA", d("2023-01-01"), d("2023-03-01"), "D"),
        ("sen", "MA", d("2020-01-03"), d("2026-01-03"), None),
        ("rep", "NY", d("2020-01-03"), d("2022-01-03"), ""),
        ("del", "MA", d("2020-01-03"), d("2029-01-03"), "Z"),
        ("rep", "TX", d("2022-01-03"), d("2020-01-03"), "backwards"),
        ("rep", "VT", d("1969-12-30"), d("1970-01-02"), "E"),
    ]
    facts = [
        (1, "MA", d("2020-01-03")), (2, "MA", d("2022-01-03")), (3, "MA", d("2024-01-03")), (4, "MA", d("2024-01-04")),
        (5, "MA", d("2023-01-15")), (6, "MA", d("2023-02-15")), (7, "NY", d("2021-01-01")), (8, "CA", d("2021-01-01")),
        (9, None, d("2021-01-01")), (10, "MA", None), (11, "MA", d("2024-01-03T00:00:01")), (12, "MA", d("2020-01-02T23:59:59")),
        (13, "TX", d("2021-01-01")), (14, "VT", d("1969-12-31T12:00:00")), (15, "VT", d("1970-01-02")),
    ]
    expected = brute_force(facts, terms)
    for options in ({}, {"broadcast_rows": None}, {"broadcast_rows": 0}, {"granularity": "microsecond"}):
        assert lookup(spark, facts, terms, **options) == expected
    got = {r[0]: r[1] for r in expected}
    assert (got[1], got[2], got[3], got[4], got[5], got[6], got[11]) == ("A", "B", "B", "Unknown", "D", "D", "Unknown")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    """A third of everything sits on one state; lengths run from one day to centuries."""
    rng = random.Random(seed)
    origin = datetime(1960, 1, 1)

    def state():
        return "HOT" if rng.random() < 0.34 else rng.choice(["A", "B", "C", None])

    def term():
        start = origin + timedelta(days=rng.randrange(0, 20000))
        length = rng.choice([0, 1, 3, 30, 365, 730, 2191, 40000])
        return (rng.choice(["rep", "sen"]), state(), start, start + timedelta(days=length), rng.choice(["D", "R", "", None]))

    terms = [t for t in (term() for _ in range(300)) if t[1]]
    facts = [
        (i, state(), origin + timedelta(days=rng.randrange(-100, 21000), seconds=rng.choice([0, 0, 1, 86399])))
        for i in range(600)
    ]
    assert lookup(spark, facts, terms) == brute_force(facts, terms)


def test_random_microseconds(spark):
    rng = random.Random(9)
    origin = datetime(2024, 1, 1)

    def moment():
        return origin + timedelta(microseconds=rng.randrange(0, 5_000_000))

    terms = []
    for _ in range(120):
        start = moment()
        terms.append(("rep", "HOT", start, start + timedelta(microseconds=rng.randrange(0, 400_000)), rng.choice("DRG")))
    facts = [(i, "HOT", moment()) for i in range(200)] + [(900 + i, "HOT", t[3]) for i, t in enumerate(terms[:20])]
    assert lookup(spark, facts, terms, granularity="microsecond") == brute_force(facts, terms)


def test_fine_bounds_are_refused_by_day_granularity(spark):
    terms = [("rep", "MA", d("2020-01-03T10:00:00"), d("2022-01-03"), "A")]
    with pytest.raises(PySparkException, match="midnight"):
        lookup(spark, [(1, "MA", d("2021-01-01"))], terms)


def test_tile_is_an_exact_partition(spark):
    """The cells of a range cover each of its ticks once and nothing else."""
    ranges = [(a, b) for a in (-70, -5, 0, 3, 16, 17) for b in (a + 1, a + 2, a + 15, a + 64, a + 333)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ranges)], "i int, a bigint, b bigint")
    for top in (1, 3, 6):
        ticks = {}
        for r in intervals.tile(df, "a", "b", top).collect():
            width = 4 ** r["level"]
            ticks.setdefault(r["i"], []).extend(range(r["cell"] * width, (r["cell"] + 1) * width))
        for i, (a, b) in enumerate(ranges):
            assert sorted(ticks[i]) == list(range(a, b))


def test_explode_terms(spark):
    def t(kind="rep", state="MA", start="2020-01-03", end="01/03/2022", party="D"):
        return (kind, state, start, end, party)

    df = spark.createDataFrame(
        [
            ([t(), t(end=None), t(start="junk"), t(state=None), t(kind=None), t(party=None)],),
            ([],),
            (None,),
            ([None, t(kind="sen")],),
        ],
        "terms array<struct<type:string,state:string,start:string,end:string,party:string>>",
    )
    bounds = (d("2020-01-03"), d("2022-01-03"))
    assert rows(intervals.explode_terms(df)) == sorted(
        [("rep", "MA", *bounds, "D"), ("rep", "MA", *bounds, None), ("sen", "MA", *bounds, "D")], key=repr
    )


def test_fact_rows_are_kept(spark):
    fact = spark.range(50).select(F.col("id").cast("int").alias("i"), F.lit("MA").alias("state"), F.lit(d("2021-01-01")).alias("day"))
    terms = spark.createDataFrame([("rep", "MA", d("2020-01-01"), d("2022-01-01"), p) for p in "ABC"], TERMS)
    got = intervals.interval_lookup(fact, terms, "state", "day", {"rep": "representant"})
    assert got.columns == ["i", "state", "day", "representant"]
    assert got.count() == 50 and rows(got.select("representant").distinct()) == [("C",)]


def test_microseconds_across_blocks(spark):
    """Nested terms from a microsecond to weeks, over many blocks, and facts at and around their bounds."""
    rng = random.Random(4)
    origin, tick = datetime(2024, 1, 1), timedelta(microseconds=1)
    terms = []
    for _ in range(250):
        start = origin + timedelta(seconds=rng.randrange(0, 2_000_000), microseconds=rng.randrange(0, 3))
        length = rng.choice([timedelta(0), tick, timedelta(hours=1), timedelta(hours=5), timedelta(days=2), timedelta(days=15)])
        terms.append((rng.choice(["rep", "sen"]), rng.choice(["HOT", "HOT", "A"]), start, start + length, rng.choice(["D", "R", "", None])))
    moments = [t[n] + step * tick for t in terms[:60] for n in (2, 3) for step in (-1, 0, 1)]
    facts = [(i, rng.choice(["HOT", "A"]), when) for i, when in enumerate(moments)]
    assert lookup(spark, facts, terms, granularity="microsecond") == brute_force(facts, terms)


def test_short_terms_are_shuffled_twice_at_most(spark):
    """Whatever the number of cells that tile them; equal ones once."""
    day = timedelta(days=1)
    for granularity, unit in (("day", day), ("microsecond", day / 2048)):
        bounds = [(datetime(2020, 1, 1) + i * unit, datetime(2020, 1, 1) + (i + 50 * (i % 3)) * unit) for i in range(0, 900, 3)]
        terms = spark.createDataFrame([("rep", "MA", s, e, p) for s, e in bounds for p in "AB"], TERMS)
        fact = spark.createDataFrame([("MA", 0, 0)], "_state string, _block bigint, _tick bigint")
        found = intervals._pieces(terms, {"rep": "r"}, granularity, fact, None).collect()
        assert len(found) <= 2 * len(bounds) and {r["_term"]["party"] for r in found} == {"B"}
