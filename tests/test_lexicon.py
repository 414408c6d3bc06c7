from __future__ import annotations

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import rows
from riskmart.functions.text import word_count, word_runs, words
from riskmart.operators import lexicon

LEX = ["bias", "equity", "équité", "hate speech", "Gender"]
TEXTS = [
    (1, None, None),
    (2, "", ""),
    (3, "--- ... !!!", "?"),
    (4, "Bias, bias and BIAS; equity-bias (biased) gender_bias", "Equity of bias"),
    (5, "l'équité ÉQUITÉ", "hate speech"),
    (6, "hate  speech, hate-speech hates speech", None),
    (7, "no hit here 42", "none"),
]


def expected(phrases):
    lex = {w.lower() for w in LEX}
    singles = {w for w in lex if " " not in w}

    def count(text):
        tokens = re.findall(r"\b\w+\b", (text or "").lower())
        found = [w for w in tokens if w in singles]
        if phrases:
            found += [g for g in map(" ".join, zip(tokens, tokens[1:])) if g in lex]
        return found, len(tokens)

    out = []
    for i, abstract, title in TEXTS:
        a, n = count(abstract)
        t, _ = count(title)
        total = len(a) + len(t)
        out.append((i, len(a), len(set(a)), len(a) / n if n else 0.0, len(t), total > 0, len(set(a)) / total if total else 0.0))
    return sorted(out, key=repr)


def frame(spark):
    return spark.createDataFrame(TEXTS, "i int, abstract string, title string")


def test_features(spark):
    for phrases in (False, True):
        got = lexicon.lexicon_features(frame(spark), LEX, phrases=phrases)
        assert rows(got, "i", *lexicon.FEATURES) == expected(phrases)


def test_join_form_agrees(spark):
    """Across the limit: any list, either form, phrases or not, the same rows."""
    entries = [*LEX, " BIAS ", "bias\t", "hate\u00a0 speech", None, ""]
    table = spark.createDataFrame([(w,) for w in entries], "flagged_word string")
    twice = frame(spark).union(frame(spark))  # no key is unique
    for phrases in (False, True):
        inline = lexicon.lexicon_features(twice, [w for w in entries if w], phrases=phrases)
        assert rows(inline, "i", *lexicon.FEATURES) == sorted(expected(phrases) * 2, key=repr)
        for limit in (100, 0):
            got = lexicon.lexicon_features_by_join(twice, table, broadcast_rows=limit, phrases=phrases)
            assert rows(got, "i", *lexicon.FEATURES) == rows(inline, "i", *lexicon.FEATURES)
    assert lexicon.lexicon_features_by_join(frame(spark).drop("abstract", "title"), table).columns == ["i", *lexicon.FEATURES]


def test_absent_columns_and_empty_lexicon(spark):
    got = lexicon.lexicon_features(frame(spark).drop("abstract"), LEX)
    assert got.agg(F.sum("flagged_word_count_abstract"), F.sum("flagged_word_count_title")).first() == (0, 2)
    nothing = lexicon.lexicon_features(frame(spark), [])
    assert set(nothing.columns) == {"i", "abstract", "title", *lexicon.FEATURES}
    assert lexicon.lexicon_coverage(nothing).first() == (0, 7)


def test_small_lexicon(spark):
    table = lexicon.normalize_lexicon(spark.createDataFrame([(" A ",), ("a",), ("b",), (None,)], "flagged_word string"))
    assert sorted(lexicon.small_lexicon(table)) == ["a", "b"]
    assert lexicon.small_lexicon(table, limit=1) is None


@given(st.lists(st.text(alphabet="aB é_1ß-.,\n٣Ⅷ", max_size=30), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None)
def test_words_match_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = df.select(words(F.col("t")), word_count(F.col("t"))).collect()
    for text, (tokens, n) in zip(texts, got):
        assert tokens == re.findall(r"\b\w+\b", text.lower()) and n == len(tokens)


def test_word_runs(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), (["a", "b"],), (["a", "b", "c", "d"],)], "t array<string>")
    got = [r[0] for r in df.select(word_runs(F.col("t"), 3)).collect()]
    assert got == [[], [], [], [], ["a b c", "b c d"]]
    assert [r[0] for r in df.select(word_runs(F.col("t"), 1)).collect()] == [[], [], ["a"], ["a", "b"], ["a", "b", "c", "d"]]


def test_runs_of_long_texts_take_linear_time(spark):
    """Words that are an expression, not a column: four times the words must not take sixteen times as long."""
    def seconds(n_words):
        text = "alpha beta gamma delta " * (n_words // 4)
        df = spark.createDataFrame([(text,)] * 8, "t string").coalesce(1).cache()
        df.count()
        job = df.select(F.sum(F.size(word_runs(words(F.col("t")), 3))))
        job.collect()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            job.collect()
            best.append(time.perf_counter() - start)
        df.unpersist()
        return min(best)

    assert seconds(80_000) < 8 * max(seconds(20_000), 0.05)


def test_long_lists_filter_words_where_texts_are_read(spark):
    """No listed word is lost, and few others go on."""
    listed = spark.range(0, 5000).selectExpr("concat('w', id * 7) AS word")
    tokens = spark.range(0, 50_000).selectExpr("id AS key", "concat('w', id) AS word")
    passed = lexicon._maybe_listed(tokens, listed, 5000)
    assert passed.join(listed, "word", "left_semi").count() == 5000
    assert passed.count() < 5000 + 0.06 * 45_000
    assert lexicon._maybe_listed(tokens, listed.filter("false"), 0).count() == 0


def test_join_form_shuffles_no_text(spark, monkeypatch):
    """Equal texts are told by digest and divided out again: no row of the shuffles holds a text."""
    plans = []
    monkeypatch.setattr(
        lexicon, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    )
    table = spark.createDataFrame([(w,) for w in LEX], "flagged_word string")
    three = frame(spark).union(frame(spark)).union(frame(spark))
    got = lexicon.lexicon_features_by_join(three, table)
    assert rows(got, "i", *lexicon.FEATURES) == sorted(expected(False) * 3, key=repr)
    assert plans and not any("first(abstract" in p or "first(title" in p for p in plans)
