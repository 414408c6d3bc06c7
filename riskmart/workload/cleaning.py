"""Cleaning, dedupe, split and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.functions import cleaning as c
from riskmart.functions.text import words
from riskmart.operators import columns, dedupe, features, lexicon, profile, split
from riskmart.sources import inference
from riskmart.workload.registry import query
from riskmart.workload.standins import FUNDED_ORDERS_SQL, documents, funded_orders


@query(
    "canonical_names",
    """SELECT c_custkey AS award_id, c_name AS customer_name, c_nationkey AS nation_key,
              c_acctbal AS nation_key_2, c_mktsegment AS market_segment FROM customer""",
)
def canonical_names(t):
    raw = t.customer.toDF(" ID ", "Customer-Name", "Nation Key", "nation-key", "__Market % Segment")
    return columns.with_canonical_names(raw, {"id": "award_id"})


@query(
    "parse_dates",
    """WITH raw AS (
         SELECT o_orderkey, CASE o_orderkey % 5
             WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
             WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
             WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
             ELSE strftime(o_orderdate, '%d.%m.%Y') END AS d, o_orderdate
         FROM orders)
       SELECT o_orderkey, coalesce(try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%Y-%m-%d'),
              try_strptime(d, '%Y-%m-%dT%H:%M:%S'), try_strptime(d, '%Y-%m-%d %H:%M:%S')) AS start_date,
              o_orderdate AS update_date, o_orderkey AS date_code FROM raw""",
)
def parse_dates(t):
    d, shape = F.col("o_orderdate"), F.col("o_orderkey") % 5
    raw = t.orders.select(
        "o_orderkey",
        F.when(shape == 0, F.date_format(d, "MM/dd/yyyy"))
        .when(shape == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(shape == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(shape == 3, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
        .alias("start_date"),
        d.alias("update_date"),
        F.col("o_orderkey").alias("date_code"),
    )
    parsed = columns.parse_date_columns(raw)
    return parsed.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("start_date", "update_date")})


@query(
    "try_cast_money",
    """WITH raw AS (
         SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '  ' || CAST(c_acctbal AS VARCHAR) || ' '
             WHEN 2 THEN '' WHEN 3 THEN '1,000' ELSE CAST(c_acctbal AS VARCHAR) END AS amt,
             CASE WHEN c_nationkey = 0 THEN 'none' ELSE CAST(c_nationkey AS VARCHAR) END AS y
         FROM customer)
       SELECT c_custkey, try_cast(amt AS DOUBLE) AS estimated_total_amt, try_cast(y AS INTEGER) AS year FROM raw""",
)
def try_cast_money(t):
    text, shape = F.col("c_acctbal").cast("string"), F.col("c_custkey") % 7
    raw = t.customer.select(
        "c_custkey",
        F.when(shape == 0, "n/a")
        .when(shape == 1, F.concat(F.lit("  "), text, F.lit(" ")))
        .when(shape == 2, "")
        .when(shape == 3, "1,000")
        .otherwise(text)
        .alias("estimatedtotalamt"),
        F.when(F.col("c_nationkey") == 0, "none").otherwise(F.col("c_nationkey").cast("string")).alias("year"),
    )
    typed = columns.apply_if_present(
        raw,
        {
            "estimated_total_amt": ("estimatedtotalamt", c.try_double),
            "funds_obligated_amt": ("fundsobligatedamt", c.try_double),
            "year": ("year", c.try_int),
        },
    )
    return typed.drop("estimatedtotalamt")


@query(
    "clean_ids",
    r"""WITH raw AS (
         SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
             WHEN 1 THEN lpad(CAST(o_orderkey AS VARCHAR), 10, '0') ELSE 'A0' || CAST(o_orderkey AS VARCHAR) END AS r
         FROM orders)
       SELECT o_orderkey, regexp_replace(r, '\.0$', '') AS award_id,
              regexp_replace(regexp_replace(r, '\.0$', ''), '^0+([0-9]+)$', '\1') AS join_key FROM raw""",
)
def clean_ids(t):
    text, shape = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 3
    raw = (
        F.when(shape == 0, F.concat(text, F.lit(".0")))
        .when(shape == 1, F.lpad(text, 10, "0"))
        .otherwise(F.concat(F.lit("A0"), text))
    )
    return t.orders.select("o_orderkey", c.clean_id(raw).alias("award_id"), c.reconcile_key(raw).alias("join_key"))


_TOKENS = ("True", "true", "1", "yes", "False", "false", "0", "no", "", "None", "NULL", "null", "maybe")


@query(
    "bool_tokens",
    f"""WITH raw AS (SELECT doc_id, quality, {list(_TOKENS)}[1 + doc_id % 14] AS v FROM labels)
       SELECT doc_id, CASE WHEN v IN ('True', 'true', '1', 'yes') THEN true
              WHEN v IN ('False', 'false', '0', 'no', '', 'None', 'NULL', 'null') THEN false END AS in_cruz_list,
              quality = 1 AS good FROM raw""",
)
def bool_tokens(t):
    token = F.get(F.array(*map(F.lit, _TOKENS)), (F.col("doc_id") % 14).cast("int"))
    return t.labels.select(
        "doc_id", c.bool_token(token).alias("in_cruz_list"), c.bool_token(F.col("quality")).alias("good")
    )


@query(
    "null_tokens",
    """WITH raw AS (
         SELECT p_partkey, p_type AS kind, CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN ' NULL ' WHEN 2 THEN 'None'
             WHEN 3 THEN ' ' || p_type || ' ' WHEN 4 THEN NULL ELSE p_type END AS category FROM part)
       SELECT p_partkey, kind, CASE WHEN trim(category) NOT IN ('', 'NULL', 'null', 'None') THEN category END
              AS sub_category FROM raw""",
)
def null_tokens(t):
    shape = F.col("p_size") % 6
    raw = t.part.select(
        "p_partkey",
        F.col("p_type").alias("kind"),
        F.when(shape == 0, "")
        .when(shape == 1, " NULL ")
        .when(shape == 2, "None")
        .when(shape == 3, F.concat(F.lit(" "), "p_type", F.lit(" ")))
        .when(shape == 4, F.lit(None))
        .otherwise(F.col("p_type"))
        .alias("sub_category"),
    )
    return columns.null_token_columns(raw)


@query(
    "nan_to_null",
    """SELECT event_id, user_id, CASE WHEN value <= 20 THEN value END AS value, event_type FROM events""",
)
def nan_to_null(t):
    raw = t.events.select(
        "event_id",
        "user_id",
        F.when(F.col("value") > 20, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "event_type",
    )
    return columns.nan_to_null(raw)


@query(
    "lexicon_normalize",
    """SELECT DISTINCT lower(trim(unnest(string_split(p_name, ' ')))) AS flagged_word FROM part""",
)
def lexicon_normalize(t):
    word = F.explode(F.split("p_name", " ")).alias("w")
    raw = t.part.select(word, "p_size").select(
        F.when(F.col("p_size") % 2 == 0, F.upper("w")).otherwise(F.concat(F.lit("  "), "w", F.lit(" "))).alias("flagged_word")
    )
    return lexicon.normalize_lexicon(raw)


@query(
    "dedupe_latest",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def dedupe_latest(t):
    return dedupe.dedupe_latest(t.events, ["user_id"], ["ts", "event_id"])


@query(
    "dedupe_report",
    """SELECT count(*) AS rows_before, count(DISTINCT user_id) AS rows_after,
              count(*) - count(DISTINCT user_id) AS rows_removed FROM events""",
)
def dedupe_report(t):
    return dedupe.dedupe_report(t.events, ["user_id"])


@query(
    "reject_split",
    """SELECT CASE WHEN NOT l_discount <= 0.08 THEN 'discount' WHEN NOT l_tax > 0 THEN 'untaxed'
              WHEN NOT l_quantity <= 45 THEN 'quantity' ELSE 'accepted' END AS outcome, count(*) AS n_rows
       FROM lineitem GROUP BY ALL""",
)
def reject_split(t):
    rules = {
        "discount": F.col("l_discount") <= 0.08, "untaxed": F.col("l_tax") > 0, "quantity": F.col("l_quantity") <= 45,
    }
    return dedupe.reject_counts(t.lineitem, rules)


@query(
    "required_keys",
    """SELECT o_orderkey AS award_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice FROM orders
       WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'""",
)
def required_keys(t):
    raw = t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("award_id"),
        F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"),
        "o_totalprice",
    )
    return columns.require(raw, ["year", "award_id"])


@query(
    "candidate_projection",
    """SELECT o_orderkey AS award_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS agency,
              o_totalprice AS estimated_total_amt, o_orderdate AS startdate FROM orders""",
)
def candidate_projection(t):
    raw = t.orders.select(
        F.col("o_custkey").alias("internal"),
        F.col("o_orderdate").alias("startdate"),
        F.col("o_orderkey").alias("award_id"),
        F.col("o_totalprice").alias("estimated_total_amt"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("agency"),
    )
    return columns.select_existing(raw)


@query(
    "year_range_scan",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows,
              '01/01/' || CAST(year(o_orderdate) AS VARCHAR) AS first_day,
              '12/31/' || CAST(year(o_orderdate) AS VARCHAR) AS last_day
       FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY ALL""",
)
def year_range_scan(t):
    per_year = profile.rows_per(columns.year_range(t.orders, "o_orderdate", 1996, 1998), "year")
    first, last = columns.year_bounds(F.col("year"))
    return per_year.withColumns({"first_day": first, "last_day": last})


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
       FROM customer UNION ALL
       SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def union_by_name(t):
    return dedupe.union_all(
        [
            t.customer.toDF("id", "name", "nation", "balance", "segment"),
            t.supplier.select(
                F.col("s_acctbal").alias("balance"),
                F.col("s_nationkey").alias("nation"),
                F.col("s_name").alias("name"),
                F.col("s_suppkey").alias("id"),
            ),
        ]
    )


_FRACTION_SQL = "('0x' || substr(md5('{salt}' || CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
_OUTER = _FRACTION_SQL.format(salt="outer:42:")
_INNER = _FRACTION_SQL.format(salt="inner:42:")


@query(
    "hash_split",
    f"SELECT o_orderkey, o_totalprice, CASE WHEN {_OUTER} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders",
)
def hash_split(t):
    return split.hash_split(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    "hash_split_nested",
    f"""SELECT o_orderkey, CASE WHEN {_INNER} < 0.8 THEN 'fit' ELSE 'valid' END AS part
        FROM orders WHERE {_OUTER} < 0.8""",
)
def hash_split_nested(t):
    train = split.hash_split(t.orders.select("o_orderkey"), "o_orderkey").filter("split = 'train'").drop("split")
    return split.hash_split(train, "o_orderkey", names=("fit", "valid"), column="part", level="inner")


def _stratified_sql(rows: str, level: str, first: str, second: str, column: str) -> str:
    """Of each status the exact share with the least digests."""
    return f"""SELECT o_orderkey, o_orderstatus, CASE WHEN
            row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('{level}:42:' || CAST(o_orderkey AS VARCHAR)))
            <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY o_orderstatus) + 0.5) THEN '{first}' ELSE '{second}' END AS {column}
        FROM {rows}"""


@query("stratified_split", _stratified_sql("orders", "outer", "train", "test", "split"))
def stratified_split(t):
    """80 % of every order status, to the row."""
    return split.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


@query(
    "stratified_split_nested",
    f"""WITH o AS ({_stratified_sql("orders", "outer", "train", "test", "split")}),
             t AS (SELECT o_orderkey, o_orderstatus FROM o WHERE split = 'train')
        {_stratified_sql("t", "inner", "fit", "valid", "part")}""",
)
def stratified_split_nested(t):
    train = stratified_split(t).filter("split = 'train'").drop("split")
    return split.stratified_split(train, "o_orderkey", "o_orderstatus", names=("fit", "valid"), column="part", level="inner")


@query(
    "funding_features",
    f"""SELECT award_id, round(funds_obligated_amt / nullif(estimated_total_amt + 1, 0), 6) AS funding_ratio,
               round(estimated_total_amt - funds_obligated_amt, 6) AS funding_difference,
               round(funds_obligated_amt / nullif(estimated_total_amt + 1, 0) * 100, 6) AS funding_efficiency
        FROM ({FUNDED_ORDERS_SQL})""",
)
def funding_features(t):
    made = features.funding_features(funded_orders(t))
    return made.select(
        "award_id", *[F.round(n, 6).alias(n) for n in ("funding_ratio", "funding_difference", "funding_efficiency")]
    )


@query(
    "log_features",
    """SELECT c_custkey, CASE WHEN c_acctbal > -1 THEN round(ln(c_acctbal + 1), 6) END AS log_funds_obligated,
              CASE WHEN c_acctbal > 499 THEN round(ln(c_acctbal - 499), 6) END AS log_estimated_total FROM customer""",
)
def log_features(t):
    raw = t.customer.select(
        "c_custkey",
        F.col("c_acctbal").alias("funds_obligated_amt"),
        (F.col("c_acctbal") - 500).alias("estimated_total_amt"),
    )
    made = features.log_features(raw)
    return made.select(
        "c_custkey", *[F.round(n, 6).alias(n) for n in ("log_funds_obligated", "log_estimated_total")]
    )


@query(
    "bool_to_int",
    """SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS is_terminated, toxic FROM labels""",
)
def bool_to_int(t):
    raw = t.labels.select(
        "doc_id", F.when(F.col("toxic") == 0, F.col("quality") == 1).alias("is_terminated"), "toxic"
    )
    return features.bool_to_int(raw, ["is_terminated", "has_flagged_words", "toxic"])


@query(
    "complete_cases",
    """SELECT c_custkey, c_name, c_nationkey AS nation, c_acctbal AS balance FROM customer
       WHERE c_acctbal >= 0 AND c_nationkey <> 3""",
)
def complete_cases(t):
    raw = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
    )
    return features.complete_cases(raw)


@query(
    "completeness_report",
    """SELECT count(*) AS n_rows, count(*) FILTER (c_acctbal >= 0 AND c_nationkey <> 3) AS n_complete,
              count(*) FILTER (c_acctbal < 0 OR c_nationkey = 3) AS n_dropped,
              count(*) FILTER (c_nationkey = 3) AS missing_nation, count(*) FILTER (c_acctbal < 0) AS missing_balance
       FROM customer""",
)
def completeness_report(t):
    raw = t.customer.select(
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
    )
    return features.completeness_report(raw)


@query(
    "class_distribution",
    """SELECT toxic AS label, count(*) AS n_rows,
              round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS pct FROM labels GROUP BY toxic""",
)
def class_distribution(t):
    return features.class_distribution(t.labels, "toxic")


@query(
    "class_weights",
    """SELECT doc_id, toxic, round((SELECT count(*) FROM labels)::DOUBLE
              / (2.0::DOUBLE * count(*) OVER (PARTITION BY toxic)), 6) AS sample_weight FROM labels""",
)
def class_weights(t):
    weighted = features.class_weights(t.labels.select("doc_id", "toxic"), "toxic")
    return weighted.withColumn("sample_weight", F.round("sample_weight", 6))


@query(
    "tokenize",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents)
       SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_words, CAST(len(list_distinct(ws)) AS INTEGER) AS n_distinct,
              ws[1] AS first_word, md5(array_to_string(ws, ' ')) AS digest FROM w""",
)
def tokenize(t):
    tokens = documents(t).select("doc_id", words(F.col("text")).alias("w"))
    return tokens.select(
        "doc_id",
        F.size("w").alias("n_words"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.get("w", F.lit(0)).alias("first_word"),
        F.md5(F.array_join("w", " ")).alias("digest"),
    )


_PROFILED = ("event_id", "ts", "user_id", "event_type", "value", "props")
_LOGICAL = {"event_id": "int", "ts": "datetime", "user_id": "int", "event_type": "string", "value": "float", "props": "string"}


@query(
    "column_profile",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{n}' AS column_name, CASE WHEN count({n}) = 0 THEN 'empty / null'
            ELSE '{_LOGICAL[n]}' END AS logical_type, count(*) AS n_rows, count({n}) AS n_filled FROM events"""
        for i, n in enumerate(_PROFILED, 1)
    )
    + " UNION ALL SELECT 7, 'nothing', 'empty / null', count(*), 0 FROM events",
)
def column_profile(t):
    return profile.column_profile(t.events.select(*_PROFILED).withColumn("nothing", F.lit(None).cast("string")))


_ZONE = {
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus",
}


@query(
    "zone_validation",
    "WITH c AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS n_rows, {11 if n == 'lineitem' else len(f.split(', '))} AS n_columns, "
        f"'{f}' AS leading_fields FROM {n}"
        for n, f in _ZONE.items()
    )
    + ") SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(n_rows) AS BIGINT), CAST(sum(n_columns) AS BIGINT), NULL FROM c",
)
def zone_validation(t):
    return profile.zone_validation({n: getattr(t, n) for n in _ZONE})


_TEXT_ORDERS_SQL = """
SELECT unnest(['order_key', 'customer_code', 'total', 'ordered_on', 'ordered_at', 'is_final', 'priority', 'note']) AS name,
       unnest([CAST(o_orderkey AS VARCHAR), lpad(CAST(o_custkey AS VARCHAR), 9, '0'), CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR),
               strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
               CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'FALSE' END, o_orderpriority, '']) AS x FROM orders"""


@query(
    "inferred_types",
    rf"""WITH v AS ({_TEXT_ORDERS_SQL}),
         c AS (SELECT name, count(*) FILTER (x <> '') AS n_values, count(*) FILTER (lower(x) IN ('true', 'false')) AS n_boolean,
             count(*) FILTER (regexp_matches(x, '^(0|-?[1-9][0-9]*)$') AND try_cast(x AS INTEGER) IS NOT NULL) AS n_int,
             count(*) FILTER (regexp_matches(x, '^(0|-?[1-9][0-9]*)$') AND try_cast(x AS BIGINT) IS NOT NULL) AS n_bigint,
             count(*) FILTER (regexp_matches(x, '^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][+-]?[0-9]+)?$')) AS n_double,
             count(*) FILTER (regexp_matches(x, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND try_cast(x AS DATE) IS NOT NULL) AS n_date,
             count(*) FILTER (try_cast(x AS TIMESTAMP) IS NOT NULL) AS n_timestamp FROM v GROUP BY name)
         SELECT name AS "column", n_values, CASE n_values WHEN 0 THEN 'void' WHEN n_boolean THEN 'boolean' WHEN n_int THEN 'int'
             WHEN n_bigint THEN 'bigint' WHEN n_double THEN 'double' WHEN n_date THEN 'date' WHEN n_timestamp THEN 'timestamp'
             ELSE 'string' END AS type FROM c""",
)
def inferred_types(t):
    """Orders as a text table: the least type that holds every value of a column, counted year by year and merged."""
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("customer_code"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered_on"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ordered_at"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("FALSE").alias("is_final"),
        F.col("o_orderpriority").alias("priority"),
        F.lit("").alias("note"),
    )
    early = F.col("ordered_on") < "1996"
    parts = inference.type_counts(raw.filter(early)).unionByName(inference.type_counts(raw.filter(~early)))
    return inference.decided(inference.merged(parts)).select("column", "n_values", "type")


@query(
    "merged_profile",
    """SELECT 'c_nationkey' AS column_name, count(*) AS n_rows, count(c_nationkey) AS n_filled, count(DISTINCT c_nationkey) AS n_distinct FROM customer
       UNION ALL SELECT 'c_mktsegment', count(*), count(c_mktsegment), count(DISTINCT c_mktsegment) FROM customer""",
)
def merged_profile(t):
    """Columns of few values, sketched in two parts and merged: small distinct counts are exact."""
    some = t.customer.select("c_nationkey", "c_mktsegment", (F.col("c_custkey") % 2).alias("part"))
    return profile.merged_profile(profile.profile_sketches(some, "part")).select("column_name", "n_rows", "n_filled", "n_distinct")
