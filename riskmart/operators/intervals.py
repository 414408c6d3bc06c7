"""Attribute valid on a date: the latest-starting closed interval that covers it.

The lookup is a stabbing query. Joining facts to intervals on the state with a range residual
would pair every fact of a busy state with every interval of it. Time is cut into blocks instead, and
facts and intervals meet per (state, block) in one sorted sweep:

* an interval is a piece in the block of its start and in that of its end; the whole blocks between them
  are written to the few cells of a hierarchy (each level four times wider) that tile them, and each cell keeps only its
  winning interval (a map-side ``max``). A block with facts looks into one cell per level, and what it finds is a
  piece of it. Of pieces that cover the same ticks of a block only the winner is kept, also map-side;
* going through a block by time, the latest piece so far answers a fact that it covers, and a fact later than the end of every
  piece so far has no answer. Only facts between the two (the latest piece is over, an earlier one is not) are open;
* a piece can answer an open fact only after the end of the piece that starts next. That rest of it is tiled into
  the cells of its block, and an open fact looks into its one cell per level.

The sweep and the cells need one shuffle, by (state, block): an interval that is shorter than a block crosses it once or
twice, whatever the number of its cells. Work is linear in facts plus intervals (times levels, for those that are open),
whatever the skew, and a busy state is split over its whole time line. Facts are first reduced to their
distinct (state, tick) pairs, so repeated dates cost nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskmart.functions.cleaning import DEFAULT_LABEL, parse_date, text_or_default
from riskmart.operators.joins import fits, measure

_LEVEL_BITS = 2  # a cell holds four cells of the level below
_BLOCK_LEVEL = {"day": 4, "microsecond": 17}  # a block spans 128 days and 4.8 hours
_TOP_LEVEL = {"day": 6, "microsecond": 24}  # the widest cells span 5.6 and 8.9 years

# Two half-day ticks per day: midnight is even, any later time of that day is odd. Interval
# bounds are midnights, so an inclusive end stops before the odd tick of its day.


def explode_terms(df: DataFrame, terms: str = "terms") -> DataFrame:
    """One row per nested term with all of type, state, start and end; bounds parsed."""
    flat = df.select(F.explode(terms).alias("t")).select(
        "t.type", "t.state", F.col("t.start").alias("start"), F.col("t.end").alias("end"), "t.party"
    )
    as_time = {
        f.name: parse_date(F.col(f.name)) if isinstance(f.dataType, T.StringType) else F.col(f.name).cast("timestamp")
        for f in flat.schema.fields
        if f.name in ("start", "end")
    }
    return flat.dropna(subset=["type", "state"]).withColumns(as_time).dropna(subset=["start", "end"])


def _tick(c: Column, granularity: str) -> Column:
    if granularity == "microsecond":
        return F.unix_micros(c.cast("timestamp"))
    day = F.to_date(c)
    return F.unix_date(day).cast("bigint") * 2 + F.when(day != c, F.lit(1)).otherwise(F.lit(0))


def _bound_tick(c: Column, granularity: str) -> Column:
    """Tick of a non-null interval bound; one finer than the granularity is an error, not a rounding.

    The coalesce only states that the tick is never null: otherwise the planner infers null
    filters from it and evaluates the whole expression again below every step.
    """
    if granularity == "microsecond":
        tick = _tick(c, granularity)
    else:
        day = F.to_date(c)
        message = F.lit("interval bound is not a midnight: use granularity='microsecond'")
        tick = F.when(day == c, F.unix_date(day).cast("bigint") * 2).otherwise(F.raise_error(message).cast("bigint"))
    return F.coalesce(tick, F.lit(0).cast("bigint"))


def _ceil_shift(value: str, level: str) -> str:
    return f"shiftright({value} + shiftleft(1L, {_LEVEL_BITS} * {level}) - 1L, {_LEVEL_BITS} * {level})"


def _floor_shift(value: str, level: str) -> str:
    return f"shiftright({value}, {_LEVEL_BITS} * {level})"


def tile(df: DataFrame, low: str, high: str, top: int, point: str = "false", levels: str | None = None) -> DataFrame:
    """Explode the half-open tick range [low, high) into the cells ``(level, cell)`` that tile it.

    A level contributes the cells inside the range whose parent is not: at most three on
    either side, and at the top level as many as the range needs. Rows where ``point`` holds get the one cell of each
    level that holds ``low``. ``levels`` is an array of levels to look at, by default all up to ``top``.
    """
    per_level = (
        df.withColumn("level", F.explode(F.expr(levels or f"sequence(0, {top})")))
        .withColumn("_from", F.expr(_ceil_shift(low, "level")))
        .withColumn("_to", F.expr(_floor_shift(high, "level")))
        .filter(f"{point} OR _from < _to")
        .withColumn("_left", F.expr(f"if(level = {top}, _to, least(_to, 4L * {_ceil_shift(low, '(level + 1)')}))"))
        .withColumn("_right", F.expr(f"greatest(_left, 4L * {_floor_shift(high, '(level + 1)')})"))
    )
    cells = F.expr(
        f"if({point}, array({_floor_shift(low, 'level')}),"
        " concat(if(_from < _left, sequence(_from, _left - 1L), array()),"
        " if(_right < _to, sequence(_right, _to - 1L), array())))"
    )
    return per_level.withColumn("cell", F.explode(cells)).drop("_from", "_to", "_left", "_right")


def _each(kinds: Mapping[str, str]) -> Column:
    return F.explode(F.array(*[F.lit(k) for k in kinds])).alias("_type")


def _pieces(
    terms: DataFrame, kinds: Mapping[str, str], granularity: str, pairs: DataFrame, asked: DataFrame | None
) -> DataFrame:
    """Per (state, block), kind and range of ticks [_low, _high) inside the block, the winning term of those that cover it.

    Whole blocks have a piece only where ``pairs`` has a fact. ``asked``, if given, holds the few blocks with
    facts: pieces of others are dropped before the shuffle.
    """
    level, top = _BLOCK_LEVEL[granularity], _TOP_LEVEL[granularity] - _BLOCK_LEVEL[granularity]
    bounds = terms.filter(F.col("type").isin(*kinds)).dropna(subset=["state", "start", "end"]).select(
        F.col("state").alias("_state"),
        F.col("type").alias("_type"),
        F.struct(
            _bound_tick(F.col("start"), granularity).alias("_start"), _bound_tick(F.col("end"), granularity).alias("_end"), "party"
        ).alias("_term"),
    ).filter("_term._start <= _term._end")
    first, last = _floor_shift("_term._start", str(level)), _floor_shift("_term._end", str(level))
    size = f"{1 << _LEVEL_BITS * level}L"
    edges = (
        bounds.withColumn("_block", F.explode(F.expr(f"array_distinct(array({first}, {last}))")))
        .withColumn("_low", F.expr(f"greatest(_term._start, _block * {size})"))
        .withColumn("_high", F.expr(f"least(_term._end + 1L, (_block + 1L) * {size})"))
        .filter(f"_high - _low < {size}")
    )
    if asked is not None:
        edges = edges.join(F.broadcast(asked), ["_state", "_block"], "left_semi")
    whole = bounds.withColumn("_low", F.expr(_ceil_shift("_term._start", str(level)))).withColumn(
        "_high", F.expr(_floor_shift("(_term._end + 1L)", str(level)))
    )
    winners = (
        tile(whole.filter("_low < _high"), "_low", "_high", top)
        .groupBy("_state", "level", "cell", "_type")
        .agg(F.max("_term").alias("_term"))
    )
    blocks = pairs.select("_state", "_block").distinct().withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    covered = (
        blocks.withColumn("cell", F.expr(_floor_shift("_block", "level")))
        .join(winners, ["_state", "level", "cell"])
        .withColumn("_low", F.expr(f"_block * {size}"))
        .withColumn("_high", F.expr(f"(_block + 1L) * {size}"))
    )
    names = ["_state", "_block", "_type", "_low", "_high"]
    found = edges.select(*names, "_term").unionByName(covered.select(*names, "_term"))
    return found.groupBy(*names).agg(F.max("_term").alias("_term"))


def _swept(pairs: DataFrame, pieces: DataFrame, kinds: Mapping[str, str], granularity: str) -> DataFrame:
    """Per (state, tick) with an answer, a column ``_{out}`` per kind with the party of the latest term that covers it."""
    level = _BLOCK_LEVEL[granularity]
    asked = pairs.select("_state", "_block", _each(kinds), F.col("_tick").alias("_low"), F.lit(True).alias("_fact"))
    both = pieces.withColumn("_fact", F.lit(False)).unionByName(asked, allowMissingColumns=True)

    # A fact comes after the pieces that start at its tick.
    block = ["_state", "_block", "_type"]
    before = Window.partitionBy(*block).orderBy("_low", "_fact", "_term").rowsBetween(Window.unboundedPreceding, -1)
    seen = both.withColumns({"_latest": F.max("_term").over(before), "_reach": F.max("_term._end").over(before)})
    block_end = f"(_block + 1L) * {1 << _LEVEL_BITS * level}L"
    # What a piece leaves for its predecessor, [_from, _until), or the tick of a fact.
    kept = seen.filter("_latest IS NOT NULL").select(
        *block, "_fact", F.col("_latest").alias("_term"),
        F.expr("_fact AND _latest._end >= _low").alias("_done"),
        F.expr("if(_fact, _low, _term._end + 1L)").alias("_begin"),
        F.expr(f"if(_fact, _low + 1L, least(_latest._end + 1L, {block_end}))").alias("_until"),
        "_reach",
    ).filter("if(_fact, _reach >= _begin, _begin < _until)")
    cells = tile(kept, "_begin", "_until", level, "_fact", f"if(_done, array(0), sequence(0, {level}))")
    offered = F.when(~F.col("_fact") | F.col("_done"), F.col("_term"))
    won = cells.withColumn("_won", F.max(offered).over(Window.partitionBy(*block, "level", "cell"))).filter("_fact")
    return (
        won.groupBy("_state", F.col("_begin").alias("_tick"))
        .agg(*[F.max(F.when(F.col("_type") == k, F.col("_won"))).alias(f"_{out}") for k, out in kinds.items()])
        .select("_state", "_tick", *[F.col(f"_{out}.party").alias(f"_{out}") for out in kinds.values()])
    )


def interval_lookup(
    fact: DataFrame,
    terms: DataFrame,
    state: str,
    date: str,
    kinds: Mapping[str, str],
    default: str = DEFAULT_LABEL,
    granularity: str = "day",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Add, per ``{type: output column}``, the party of the latest term covering the fact's date.

    Bounds are inclusive; several matches resolve to the last by (start, end, party); no match,
    a null state or date, and a null or empty party give ``default``. ``terms`` has the columns
    of :func:`explode_terms`. ``granularity="day"`` needs midnight bounds (facts may carry any
    time of day) and fails loudly on others; ``"microsecond"`` takes any timestamp.

    No job runs while the query is built, and facts and terms are read for the lookup and the
    facts once more for the join back, whose form adaptive execution picks from real sizes. With
    ``broadcast_rows`` the distinct (state, tick) pairs are counted first: if they stay below it, and below
    a fixed number of bytes, their blocks are broadcast to thin out the intervals before their
    shuffle, which pays when few dates meet many intervals.
    """
    keyed = fact.withColumns({"_state": F.col(state), "_tick": _tick(F.col(date), granularity)})
    pairs = keyed.select("_state", "_tick").dropna().distinct()
    size = measure(pairs) if broadcast_rows is not None else None
    pairs = pairs.withColumn("_block", F.expr(_floor_shift("_tick", str(_BLOCK_LEVEL[granularity]))))
    few = size is not None and fits(size, broadcast_rows)
    asked = pairs.select("_state", "_block").distinct() if few else None
    answers = _swept(pairs, _pieces(terms, kinds, granularity, pairs, asked), kinds, granularity)
    if size is not None:
        widest = terms.agg(F.max(F.octet_length("party"))).first()[0] or 0
        size = (size[0], size[1] + size[0] * len(kinds) * widest)
    if size is not None and fits(size, broadcast_rows):
        answers = F.broadcast(answers)
    return (
        keyed.join(answers, ["_state", "_tick"], "left")
        .withColumns({out: text_or_default(F.col(f"_{out}"), default) for out in kinds.values()})
        .drop("_state", "_tick", *[f"_{out}" for out in kinds.values()])
    )
