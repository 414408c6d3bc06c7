"""Paged feeds and nested documents."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from riskmart.functions import cleaning
from riskmart.operators import intervals, pages
from riskmart.plans import incremental, landing
from riskmart.sinks import upsert
from riskmart.sinks.scratch import run_folder
from riskmart.sources import feed, readers, schemas
from riskmart.workload.registry import query
from riskmart.workload.standins import DAILY_PAGES_SQL, daily_pages

_ENVELOPE = "struct<response: struct<award: array<struct<id: string, line: string>>, serviceNotification: string>>"


@query(
    "envelope_explode",
    """WITH l AS (SELECT conv_id, turn, string_split(text, chr(10)) AS ls FROM conversations
                  WHERE NOT (role = 'user' AND turn >= 2)),
            i AS (SELECT conv_id, turn, ls, unnest(generate_series(1, len(ls))) AS i FROM l)
       SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-' || CAST(i - 1 AS VARCHAR) AS id,
              ls[i] AS line FROM i""",
)
def envelope_explode(t):
    """Turns as JSON page envelopes: late user turns are error envelopes, lines are the awards."""
    failed = (F.col("role") == "user") & (F.col("turn") >= 2)
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(F.concat_ws("-", "conv_id", "turn", i).alias("id"), line.alias("line")),
    )
    body = F.struct(
        F.struct(
            F.when(~failed, lines).alias("award"),
            F.when(failed, F.lit("rate limited")).alias("serviceNotification"),
        ).alias("response")
    )
    raw = t.conversations.select(F.to_json(body).alias("body"))
    return pages.explode_envelope(raw.select(F.from_json("body", _ENVELOPE).alias("e")).select("e.*"))


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '' AS missing FROM events",
)
def json_field(t):
    return t.events.select(
        "event_id", cleaning.json_field(F.col("props"), "k", "bigint").alias("k"),
        cleaning.json_field(F.col("props"), "j", default="").alias("missing"),
    )


@query(
    "page_audit_events",
    f"""WITH p AS ({DAILY_PAGES_SQL}),
        o AS (SELECT feed, "offset", count(*) AS copies, bool_and(failed) AS failed,
                     max(n_rows) FILTER (NOT failed) AS rows, coalesce(sum(n_rows) FILTER (NOT failed), 0) AS every
              FROM p GROUP BY feed, "offset"),
        a AS (SELECT feed, count(*) AS n_pages, CAST(sum(every) AS BIGINT) AS n_rows,
                     max("offset") FILTER ("offset" % 25 = 0) AS last_offset, count(*) FILTER (failed) AS failed_pages,
                     CAST(sum(copies - 1) AS BIGINT) AS duplicate_pages, count(*) FILTER ("offset" % 25 <> 0) AS misaligned_pages,
                     count(*) FILTER ("offset" % 25 = 0) AS aligned, count(*) FILTER (NOT failed AND rows < 25) AS n_short,
                     arg_max(coalesce(NOT failed AND rows < 25, false), "offset") AS ends_short FROM o GROUP BY feed),
        b AS (SELECT *, coalesce(last_offset // 25 + 1 - aligned, 0) AS missing_pages,
                     n_short - CAST(ends_short AS INTEGER) AS early_short_pages FROM a)
        SELECT feed, n_pages, n_rows, last_offset, failed_pages, duplicate_pages, misaligned_pages, ends_short, missing_pages,
               early_short_pages, ends_short AND early_short_pages = 0 AND missing_pages = 0 AND failed_pages = 0
               AND duplicate_pages = 0 AND misaligned_pages = 0 AS complete FROM b""",
)
def page_audit_events(t):
    return pages.page_audit(daily_pages(t), "feed", "offset", "n_rows", "failed")


@query(
    "page_landing",
    """WITH e AS (SELECT *, event_id // 25 AS page, CAST(ts AS DATE) AS feed FROM events),
            p AS (SELECT feed, page FROM e GROUP BY feed, page HAVING count(*) FILTER (event_type = 'error') < 10)
       SELECT e.feed, CAST(event_id AS VARCHAR) AS id, event_type AS agency, CAST(user_id AS VARCHAR) AS extra_user
       FROM e JOIN p USING (feed, page)""",
)
def page_landing(t):
    """Events as the awards of daily page files: every row of every readable page, listed fields and others."""
    bodies = page_bodies(t).select("year", "offset", F.from_json("body", schemas.ENVELOPE).alias("e"))
    read = readers.page_columns(bodies.select("year", "offset", "e.*"))
    return _landed(read)


def page_bodies(t):
    """The events of a day in pages of 25 consecutive ids, each an envelope with an award per event."""
    award = F.map_from_arrays(
        F.array(F.lit("id"), F.lit("agency"), F.lit("user")),
        F.array(F.col("event_id").cast("string"), F.col("event_type"), F.col("user_id").cast("string")),
    )
    return (
        t.events.groupBy(F.to_date("ts").alias("year"), F.floor(F.col("event_id") / 25).alias("offset"))
        .agg(F.collect_list(award).alias("award"), F.count_if(F.col("event_type") == "error").alias("errors"))
        .select("year", "offset", F.to_json(F.struct(F.struct(
            F.when(F.col("errors") < 10, F.col("award")).alias("award"),
            F.when(F.col("errors") >= 10, F.lit("rate limited")).alias("serviceNotification"),
        ).alias("response"))).alias("body"))
    )


def _landed(pages):
    found = landing.awards_of(pages)
    return found.select(F.col("year").alias("feed"), "id", "agency", F.col("extra")["user"].alias("extra_user"))


def daily_feed(t):
    """The same pages as files of a paged feed, and the feed read back as a source."""
    root = f"{run_folder(t.spark)}/feed-{uuid.uuid4().hex}"
    pages = page_bodies(t).select(F.col("year").cast("string").alias("feed"), F.col("offset").alias("page"), "body")
    first = t.events.groupBy(F.to_date("ts").cast("string").alias("feed")).agg(F.min(F.floor(F.col("event_id") / 25)).alias("first_page"))
    feed.write_feed(pages.join(first, "feed").withColumn("offset", (F.col("page") - F.col("first_page")) * 25), root)
    return feed.read_feed(t.spark, root, rowsPerPage=25)


_FEED_LANDING_SQL = """WITH e AS (SELECT *, event_id // 25 AS page, CAST(ts AS DATE) AS feed FROM events),
            p AS (SELECT feed, page FROM e GROUP BY feed, page HAVING count(*) FILTER (event_type = 'error') < 10)
       SELECT CAST(e.feed AS VARCHAR) AS feed, CAST(event_id AS VARCHAR) AS id, event_type AS agency,
              CAST(user_id AS VARCHAR) AS extra_user
       FROM e JOIN p USING (feed, page)"""


@query("feed_landing", _FEED_LANDING_SQL)
def feed_landing(t):
    """Every award of every page of the feed, through the paged source: the rows of ``page_landing``."""
    return _landed(feed.parsed(daily_feed(t)))


FEED_FROM, FEED_TO = date(2024, 1, 8), date(2024, 1, 21)


@query("feed_date_range", f"{_FEED_LANDING_SQL} WHERE e.feed BETWEEN DATE '{FEED_FROM}' AND DATE '{FEED_TO}'")
def feed_date_range(t):
    """Awards that start within two weeks: the range is pushed to the source, which opens no page of other days."""
    return _landed(feed.parsed(daily_feed(t).filter(feed.between_dates(FEED_FROM, FEED_TO))))


@query("feed_incremental", _FEED_LANDING_SQL)
def feed_incremental(t):
    """The feed downloaded in two goes, the second with pages of the first again: landed by a stream, each award once."""
    root = f"{run_folder(t.spark)}/growing-{uuid.uuid4().hex}"
    pages = page_bodies(t).select(F.col("year").cast("string").alias("feed"), (F.col("offset") * 25).alias("offset"), "body")
    first = F.col("feed") <= F.lit(str(FEED_TO))
    for part in (pages.filter(first), pages.filter(~first).union(pages.filter("offset % 100 = 0").withColumn("offset", F.col("offset") + 1))):
        feed.write_feed(part, f"{root}/pages")
        incremental.land_new_pages(t.spark, f"{root}/pages", f"{root}/landed", f"{root}/checkpoint", "feed")
    found = incremental.landed(t.spark, f"{root}/landed")
    return found.select(F.col("year").alias("feed"), "id", "agency", F.col("extra")["user"].alias("extra_user"))


@query(
    "keyed_update",
    """WITH late AS (SELECT * FROM orders WHERE o_orderkey >= (SELECT 0.9 * max(o_orderkey) FROM orders))
       SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)
       UNION ALL SELECT o_orderkey, o_custkey, 'checked', o_totalprice * 2 FROM late
       UNION ALL SELECT -1 - o_orderkey, o_custkey, 'added', 0.0 FROM late WHERE o_orderpriority = '1-URGENT'""",
)
def keyed_update(t):
    """A table of orders in which the latest tenth is replaced by key, with new orders for the urgent ones."""
    path = f"{run_folder(t.spark)}/updated-{uuid.uuid4().hex}"
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    orders.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    last = orders.agg(F.max("o_orderkey")).first()[0]
    late = orders.filter(F.col("o_orderkey") >= 0.9 * (last or 0))
    checked = late.withColumns({"o_orderpriority": F.lit("checked"), "o_totalprice": F.col("o_totalprice") * 2})
    added = late.filter("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderkey": -1 - F.col("o_orderkey"), "o_orderpriority": F.lit("added"), "o_totalprice": F.lit(0.0)}
    )
    upsert.replace_by_key(checked.unionByName(added), path, "o_orderkey")
    return t.spark.read.parquet(path)


@query(
    "explode_terms",
    """WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
                         unnest(generate_series(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER))) AS i FROM orders)
       SELECT CASE WHEN i % 2 = 0 THEN 'rep' ELSE 'sen' END AS type,
              CAST(o_custkey AS VARCHAR) AS state,
              o_orderdate + to_days(CAST(i AS INTEGER)) AS start, o_orderdate + to_days(CAST(100 * i AS INTEGER)) AS "end",
              CASE WHEN i <> 3 THEN o_orderstatus END AS party
       FROM n WHERE i <> 4 AND i <> 5""",
)
def explode_terms(t):
    """Each order carries as many nested terms as its priority; the 4th lacks its end, the 5th has junk for it."""
    terms = F.expr(
        """transform(sequence(1, cast(substr(o_orderpriority, 1, 1) AS int)), i -> named_struct(
             'type', if(i % 2 = 0, 'rep', 'sen'), 'state', cast(o_custkey AS string),
             'start', date_format(o_orderdate + make_dt_interval(i), 'yyyy-MM-dd'),
             'end', case i when 4 then null when 5 then 'open' else
                    date_format(o_orderdate + make_dt_interval(100 * i), 'MM/dd/yyyy') end,
             'party', if(i <> 3, o_orderstatus, null)))"""
    )
    flat = intervals.explode_terms(t.orders.select(terms.alias("terms")))
    return flat.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("start", "end")})
