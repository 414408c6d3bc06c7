"""The supplied tables dressed up as the raw datasets, once in Spark and once in SQL.

Each SQL constant is a common table expression body equal to the DataFrame beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.workload.registry import Tables

# A list of words frequent in the supplied texts (the public list has no hit in them).
WORDS = ("the", "of", "de", "and", "to", "in", "la", "der")
WORDS_SQL = ", ".join(f"'{w}'" for w in WORDS)

MODEL_SCORES = {
    "price": "l_extendedprice / 110000.0D",
    "quantity": "l_quantity / 50.0D",
    "discount": "l_discount * 10.0D",
}


def _lines(t: Tables, *columns: str) -> DataFrame:
    return t.lineitem.select(*columns)


def documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


def terms(t: Tables) -> DataFrame:
    """Validity intervals: a line's shipping window, with its supplier as the state."""
    return _lines(t, "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate").select(
        F.col("l_linestatus").alias("type"),
        F.col("l_suppkey").cast("string").alias("state"),
        F.col("l_shipdate").alias("start"),
        F.expr("l_shipdate + make_dt_interval(cast(l_quantity AS int))").alias("end"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("").alias("party"),
    )


TERMS_SQL = """
SELECT l_linestatus AS type, CAST(l_suppkey AS VARCHAR) AS state, l_shipdate AS s,
       l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS e,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag ELSE '' END AS party
FROM lineitem"""


def dated_orders(t: Tables) -> DataFrame:
    """Orders as dated facts with a state."""
    suppliers = t.supplier.agg(F.count(F.lit(1))).scalar()
    return t.orders.select(
        F.col("o_orderkey").alias("award_id"),
        (F.col("o_custkey") % suppliers).cast("string").alias("perfstatecode"),
        F.col("o_orderdate").alias("startdate"),
    )


DATED_ORDERS_SQL = """
SELECT o_orderkey AS award_id, CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS perfstatecode,
       o_orderdate AS startdate
FROM orders"""


def titled_documents(t: Tables) -> DataFrame:
    """Documents with their first line as title and the rest as abstract."""
    return documents(t).select(
        "doc_id",
        F.substring_index("text", "\n", 1).alias("title"),
        F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)").alias("abstract"),
    )


TITLED_DOCUMENTS_SQL = """
SELECT doc_id, split_part(text, chr(10), 1) AS title,
       substr(text, length(split_part(text, chr(10), 1)) + 2) AS abstract
FROM documents"""


def word_table(t: Tables) -> DataFrame:
    """A word list that grows with the data: every word of the benchmark passages."""
    return t.benchmark.select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")).alias("flagged_word")
    ).filter("flagged_word <> ''")


WORD_TABLE_SQL = """
SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS flagged_word FROM benchmark"""


def funded_orders(t: Tables) -> DataFrame:
    """Orders with planned money (the order total) and funded money (their discounted lines).

    The sum is taken in decimals: it does not depend on the order of the rows.
    """
    funded = t.lineitem.groupBy(F.col("l_orderkey").alias("award_id")).agg(
        F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)"))
        .cast("double")
        .alias("funds_obligated_amt")
    )
    return (
        t.orders.select(F.col("o_orderkey").alias("award_id"), F.col("o_totalprice").alias("estimated_total_amt"))
        .join(funded, "award_id", "left")
    )


FUNDED_ORDERS_SQL = """
SELECT o_orderkey AS award_id, o_totalprice AS estimated_total_amt, f.funds_obligated_amt
FROM orders LEFT JOIN (
  SELECT l_orderkey, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS funds_obligated_amt
  FROM lineitem GROUP BY l_orderkey) f ON o_orderkey = f.l_orderkey"""


def predictions(t: Tables) -> DataFrame:
    """Three closed-form models scoring every line for the label 'returned'."""
    scored = ", ".join(f"struct('{m}' AS model, {e} AS score)" for m, e in MODEL_SCORES.items())
    return t.lineitem.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.when(F.col("l_linestatus") == "O", "valid").otherwise("test").alias("split"),
        F.expr(f"inline(array({scored}))"),
    ).withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))


PREDICTIONS_SQL = """
SELECT label, split, model, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM (
""" + " UNION ALL ".join(
    f"""SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
       CASE WHEN l_linestatus = 'O' THEN 'valid' ELSE 'test' END AS split,
       '{m}' AS model, {e.replace('.0D', '.0::DOUBLE')} AS score FROM lineitem"""
    for m, e in MODEL_SCORES.items()
) + ")"


def runs(t: Tables) -> DataFrame:
    """One training run per user: metrics and times from the user's events."""

    def value(kind: str):
        return F.max(F.when(F.col("event_type") == kind, F.col("value") / 1000.0))

    return t.events.groupBy("user_id").agg(
        F.max("ts").alias("start_time"),
        F.create_map(
            F.lit("valid_accuracy"), value("click"), F.lit("valid_f1_score"), value("view"),
            F.lit("valid_auc_roc"), value("purchase"),
        ).alias("metrics"),
    ).select(
        F.format_string("run-%05d", "user_id").alias("run_id"),
        F.concat(F.lit("model_"), (F.col("user_id") % 3).cast("string")).alias("run_name"),
        F.lit("grants").alias("experiment"),
        "start_time",
        "metrics",
    )


RUNS_SQL = """
SELECT printf('run-%05d', user_id) AS run_id, 'model_' || CAST(user_id % 3 AS VARCHAR) AS run_name,
       'grants' AS experiment, max(ts) AS start_time,
       max(CASE WHEN event_type = 'click' THEN value / 1000.0::DOUBLE END) AS valid_accuracy,
       max(CASE WHEN event_type = 'view' THEN value / 1000.0::DOUBLE END) AS valid_f1_score,
       max(CASE WHEN event_type = 'purchase' THEN value / 1000.0::DOUBLE END) AS valid_auc_roc
FROM events GROUP BY user_id"""


def daily_pages(t: Tables, rpp: int = 25) -> DataFrame:
    """Events as one paged feed per day: 25 consecutive event ids make a page.

    A page counts as failed when errors make up two fifths of it, and as lost from twelve errors on.
    Every 7th page was downloaded twice and every 13th lies off the grid.
    """
    pages = (
        t.events.groupBy(F.to_date("ts").alias("feed"), F.floor(F.col("event_id") / rpp).alias("page"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
    )
    first = pages.groupBy("feed").agg(F.min("page").alias("first_page"))
    return (
        pages.join(first, "feed")
        .filter("n_errors < 12")
        .withColumn("copy", F.explode(F.expr("if(page % 7 = 3, array(1, 2), array(1))")))
        .select(
            "feed",
            ((F.col("page") - F.col("first_page")) * rpp + F.when(F.col("page") % 13 == 4, 10).otherwise(0)).alias("offset"),
            "n_rows",
            (F.col("n_errors") >= 10).alias("failed"),
        )
    )


DAILY_PAGES_SQL = """
SELECT feed, (page - first_page) * 25 + CASE WHEN page % 13 = 4 THEN 10 ELSE 0 END AS "offset", n_rows, n_errors >= 10 AS failed
FROM (SELECT *, min(page) OVER (PARTITION BY feed) AS first_page FROM (
        SELECT CAST(ts AS DATE) AS feed, event_id // 25 AS page, count(*) AS n_rows,
               count(*) FILTER (event_type = 'error') AS n_errors
        FROM events GROUP BY ALL)),
     (SELECT unnest([1, 2]) AS copy)
WHERE n_errors < 12 AND (copy = 1 OR page % 7 = 3)"""
