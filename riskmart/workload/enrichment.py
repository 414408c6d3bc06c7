"""Flags, interval lookups, text features and the wide table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.operators import columns, intervals, lexicon, membership, split
from riskmart.workload.registry import query
from riskmart.workload.standins import (
    DATED_ORDERS_SQL, TERMS_SQL, TITLED_DOCUMENTS_SQL, WORD_TABLE_SQL, WORDS, WORDS_SQL,
    dated_orders, documents, terms, titled_documents, word_table,
)


def _padded(t, condition):
    """A key list as another system would export it: zero-padded, or numeric with ``.0``; repeated."""
    key = F.col("doc_id").cast("string")
    listed = t.labels.filter(condition)
    return listed.select(F.lpad(key, 9, "0").alias("k")).union(listed.select(F.concat(key, F.lit(".0"))))


@query(
    "membership_flag",
    """SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS in_cruz_list FROM documents""",
)
def membership_flag(t):
    listed = _padded(t, F.col("quality") == 1)
    return membership.membership_flag(t.documents.select("doc_id", "lang"), listed, "doc_id", "k", "in_cruz_list")


@query(
    "membership_flag_shuffled",
    """SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS in_cruz_list FROM documents""",
)
def membership_flag_shuffled(t):
    """The same flag by salted shuffle, as for a list past the broadcast bound."""
    listed = _padded(t, F.col("quality") == 1)
    fact = t.documents.select("doc_id", "lang")
    return membership.membership_flag(fact, listed, "doc_id", "k", "in_cruz_list", broadcast_rows=0)


@query(
    "label_flag",
    """SELECT doc_id, source, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS is_terminated FROM documents""",
)
def label_flag(t):
    listed = _padded(t, F.col("toxic") == 1)
    return membership.membership_flag(t.documents.select("doc_id", "source"), listed, "doc_id", "k", "is_terminated")


def _lookup_sql(kind: str, out: str) -> str:
    return f"""(SELECT f.award_id, coalesce(nullif(arg_max_null(party, (s, e, coalesce(party, ''))), ''), 'Unknown') AS {out}
        FROM f LEFT JOIN t ON t.state = f.perfstatecode AND t.type = '{kind}' AND t.s <= f.startdate AND t.e >= f.startdate
        GROUP BY f.award_id)"""


@query(
    "interval_lookup",
    f"""WITH t AS ({TERMS_SQL}), f AS ({DATED_ORDERS_SQL})
        SELECT f.*, r.representant FROM f JOIN {_lookup_sql('O', 'representant')} r USING (award_id)""",
)
def interval_lookup(t):
    return intervals.interval_lookup(dated_orders(t), terms(t), "perfstatecode", "startdate", {"O": "representant"})


@query(
    "interval_lookup_two_types",
    f"""WITH t AS ({TERMS_SQL}), f AS ({DATED_ORDERS_SQL})
        SELECT f.award_id, r.representant, s.senator FROM f
        JOIN {_lookup_sql('O', 'representant')} r USING (award_id)
        JOIN {_lookup_sql('F', 'senator')} s USING (award_id)""",
)
def interval_lookup_two_types(t):
    found = intervals.interval_lookup(
        dated_orders(t), terms(t), "perfstatecode", "startdate", {"O": "representant", "F": "senator"}
    )
    return found.select("award_id", "representant", "senator")


@query(
    "interval_lookup_events",
    """WITH t AS (SELECT CAST(user_id % 50 AS VARCHAR) AS state, ts + INTERVAL 1 MICROSECOND AS s, ts + INTERVAL 3 HOUR AS e,
                         event_type AS party FROM events),
            f AS (SELECT event_id, CAST(user_id % 50 AS VARCHAR) AS state, ts FROM events)
       SELECT f.event_id, coalesce(nullif(arg_max_null(party, (s, e, coalesce(party, ''))), ''), 'Unknown') AS representant
       FROM f LEFT JOIN t ON t.state = f.state AND t.s <= f.ts AND t.e >= f.ts GROUP BY f.event_id""",
)
def interval_lookup_events(t):
    """For every event, what the latest earlier one of its user group was, if at most three hours before."""
    state = (F.col("user_id") % 50).cast("string")
    windows = t.events.select(
        F.lit("event").alias("type"), state.alias("state"), (F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).alias("start"),
        (F.col("ts") + F.expr("INTERVAL 3 HOURS")).alias("end"), F.col("event_type").alias("party"),
    )
    facts = t.events.select("event_id", state.alias("state"), "ts")
    found = intervals.interval_lookup(facts, windows, "state", "ts", {"event": "representant"}, granularity="microsecond")
    return found.select("event_id", "representant")


def _features_sql(words: str, docs: str = TITLED_DOCUMENTS_SQL) -> str:
    """The six features by exploding words and joining, with ``words`` a query for the list."""
    return f"""
    w AS ({words}),
    d AS ({docs}),
    a AS (SELECT doc_id, unnest(regexp_extract_all(lower(abstract), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM d),
    b AS (SELECT doc_id, unnest(regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM d),
    ca AS (SELECT doc_id, count(*) AS total, count(*) FILTER (word IN (FROM w)) AS n,
                  count(DISTINCT word) FILTER (word IN (FROM w)) AS u FROM a GROUP BY doc_id),
    cb AS (SELECT doc_id, count(*) FILTER (word IN (FROM w)) AS n FROM b GROUP BY doc_id),
    feat AS (SELECT d.doc_id,
        CAST(coalesce(ca.n, 0) AS INTEGER) AS flagged_word_count_abstract,
        CAST(coalesce(ca.u, 0) AS INTEGER) AS flagged_word_unique_abstract,
        round(coalesce(ca.n::DOUBLE / ca.total, 0), 6) AS flagged_word_ratio_abstract,
        CAST(coalesce(cb.n, 0) AS INTEGER) AS flagged_word_count_title,
        coalesce(ca.n, 0) + coalesce(cb.n, 0) > 0 AS has_flagged_words,
        round(coalesce(coalesce(ca.u, 0)::DOUBLE / nullif(coalesce(ca.n, 0) + coalesce(cb.n, 0), 0), 0), 6)
            AS flagged_word_diversity_score
      FROM d LEFT JOIN ca USING (doc_id) LEFT JOIN cb USING (doc_id))"""


_INLINE_WORDS = f"SELECT unnest([{WORDS_SQL}])"


def _rounded(df):
    ratios = ("flagged_word_ratio_abstract", "flagged_word_diversity_score")
    return df.withColumns({n: F.round(n, 6) for n in ratios})


@query("lexicon_features", f"WITH {_features_sql(_INLINE_WORDS)} SELECT * FROM feat")
def lexicon_features(t):
    made = lexicon.lexicon_features(titled_documents(t), WORDS)
    return _rounded(made).select("doc_id", *lexicon.FEATURES)


@query("lexicon_features_large", f"WITH {_features_sql(WORD_TABLE_SQL)} SELECT * FROM feat")
def lexicon_features_large(t):
    made = lexicon.lexicon_features_by_join(titled_documents(t), word_table(t))
    return _rounded(made).select("doc_id", *lexicon.FEATURES)


_PHRASES = ("of the", "in la", "de la", "and the", "to the in", "the")


@query(
    "lexicon_phrases",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents),
             p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
             m AS (SELECT doc_id, unnest([ws[i], ws[i] || ' ' || ws[i + 1], ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]])
                          AS g FROM p)
        SELECT w.doc_id, CAST(count(g) FILTER (g IN ('of the', 'in la', 'de la', 'and the', 'to the in', 'the'))
                         AS INTEGER) AS n_hits
        FROM w LEFT JOIN m USING (doc_id) GROUP BY w.doc_id""",
)
def lexicon_phrases(t):
    made = lexicon.lexicon_features(documents(t), _PHRASES, abstract="text", phrases=True)
    return made.select("doc_id", F.col("flagged_word_count_abstract").alias("n_hits"))


_PHRASES_SQL = r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents),
             p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
             m AS (SELECT doc_id, unnest([ws[i], ws[i] || ' ' || ws[i + 1], ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]])
                          AS g FROM p)
        SELECT w.doc_id, CAST(count(g) FILTER (g IN (SELECT unnest(%s))) AS INTEGER) AS n_hits
        FROM w LEFT JOIN m USING (doc_id) GROUP BY w.doc_id"""


@query("lexicon_phrases_large", _PHRASES_SQL % str(list(_PHRASES)))
def lexicon_phrases_large(t):
    """The phrases as a table, matched by the join form past the broadcast bound: the answer of the inline form."""
    rows = [(f" {p.upper()}\t",) for p in _PHRASES] + [(None,), ("",)]
    table = t.spark.createDataFrame(rows, "flagged_word string")
    made = lexicon.lexicon_features_by_join(
        documents(t), table, abstract="text", broadcast_rows=0, phrases=True
    )
    return made.select("doc_id", F.col("flagged_word_count_abstract").alias("n_hits"))


@query(
    "lexicon_coverage",
    f"WITH {_features_sql(_INLINE_WORDS)} SELECT count(*) FILTER (has_flagged_words) AS n_hit, count(*) AS n_rows FROM feat",
)
def lexicon_coverage(t):
    return lexicon.lexicon_coverage(lexicon.lexicon_features(titled_documents(t), WORDS))


@query(
    "lexicon_semi_join",
    rf"""WITH w AS ({WORD_TABLE_SQL}),
             o AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS word FROM documents)
        SELECT doc_id, word, count(*) AS n FROM o WHERE word IN (FROM w) GROUP BY doc_id, word""",
)
def lexicon_semi_join(t):
    return lexicon.lexicon_hits(documents(t), "doc_id", ["text"], word_table(t)).drop("part")


_WIDE_DOCS_SQL = f"""
SELECT d.doc_id, d.title, d.abstract, CAST(d.doc_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS perfstatecode,
       TIMESTAMP '1995-01-01' + to_days(CAST(d.doc_id % 2400 AS INTEGER)) AS startdate
FROM ({TITLED_DOCUMENTS_SQL}) d"""


def wide_facts(t):
    """Documents as awards: a key, a state, a start date, a title and an abstract."""
    suppliers = t.supplier.agg(F.count(F.lit(1))).scalar()
    day = F.expr("make_dt_interval(cast(doc_id % 2400 AS int))")
    return titled_documents(t).select(
        F.col("doc_id").alias("award_id"),
        "title",
        "abstract",
        (F.col("doc_id") % suppliers).cast("string").alias("perfstatecode"),
        (F.lit("1995-01-01").cast("timestamp_ntz") + day).alias("startdate"),
    )


@query(
    "exploitation_table",
    f"""WITH t AS ({TERMS_SQL}), {_features_sql(_INLINE_WORDS, _WIDE_DOCS_SQL)},
        f AS (SELECT doc_id AS award_id, * EXCLUDE (doc_id) FROM d)
        SELECT f.award_id, CAST(year(f.startdate) AS INTEGER) AS year, f.perfstatecode, f.startdate, f.title,
               f.award_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS in_cruz_list,
               f.award_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS is_terminated,
               r.representant, s.senator, feat.* EXCLUDE (doc_id),
               CASE WHEN ('0x' || substr(md5('outer:42:' || CAST(f.award_id AS VARCHAR)), 1, 8))::BIGINT
                    / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS split
        FROM f JOIN {_lookup_sql('O', 'representant')} r USING (award_id)
        JOIN {_lookup_sql('F', 'senator')} s USING (award_id) JOIN feat ON feat.doc_id = f.award_id""",
)
def exploitation_table(t):
    """The flagship: flags, label, both lookups, text features and the split in one plan."""
    fact = wide_facts(t).withColumn("year", F.year("startdate"))
    fact = membership.membership_flag(fact, _padded(t, F.col("quality") == 1), "award_id", "k", "in_cruz_list")
    fact = membership.membership_flag(fact, _padded(t, F.col("toxic") == 1), "award_id", "k", "is_terminated")
    fact = intervals.interval_lookup(
        fact, terms(t), "perfstatecode", "startdate", {"O": "representant", "F": "senator"}
    )
    fact = _rounded(lexicon.lexicon_features(fact, WORDS))
    fact = split.hash_split(columns.require(fact, ["year", "award_id"]), "award_id")
    return columns.select_existing(
        fact, (*columns.CANDIDATE_COLUMNS, "representant", "senator", *lexicon.FEATURES, "split")
    )
