"""Word-list features of free text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions import text
from riskmart.functions.cleaning import normalize_word
from riskmart.functions.numeric import ratio_or_zero
from riskmart.operators.dedupe import key_set
from riskmart.operators.joins import BROADCAST_ROWS, fits, lookup_join, measure
from riskmart.sinks.scratch import written

# A list past the broadcast bound is first met as a filter of LIST_BITS bits an entry, in blocks of BLOCK_BITS, MOST_BITS in all.
LIST_BITS, BLOCK_BITS, MOST_BITS = 32, 32_768, 1 << 27

# The six text features of the wide table.
FEATURES = (
    "flagged_word_count_abstract", "flagged_word_unique_abstract", "flagged_word_ratio_abstract",
    "flagged_word_count_title", "has_flagged_words", "flagged_word_diversity_score",
)


def normalize_lexicon(df: DataFrame, word: str = "flagged_word") -> DataFrame:
    """Distinct trimmed, lower-case words."""
    return key_set(df, normalize_word(F.col(word)), word)


def small_lexicon(df: DataFrame, word: str = "flagged_word", limit: int = 2_000) -> list[str] | None:
    """The words as a list if there are at most ``limit``, else None (use the join form).

    Both forms give the same features; the limit only says which plan is the cheaper one.
    """
    found = [r[0] for r in df.select(word).filter(F.col(word).isNotNull()).distinct().take(limit + 1)]
    return found if len(found) <= limit else None


def _found(tokens: Column, lexicon: Sequence[str], phrases: bool) -> Column:
    singles = [w for w in lexicon if " " not in w]
    parts = [text.hits(tokens, singles)]
    if phrases:
        lengths = sorted({len(w.split()) for w in lexicon if " " in w})
        for n in lengths:
            wanted = [" ".join(w.split()) for w in lexicon if len(w.split()) == n and " " in w]
            parts.append(text.phrase_hits(tokens, wanted, n))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _finish(df: DataFrame, count_a: Column, unique_a: Column, words_a: Column, count_t: Column) -> DataFrame:
    values = (
        count_a,
        unique_a,
        ratio_or_zero(count_a, words_a),
        count_t,
        (count_a > 0) | (count_t > 0),
        ratio_or_zero(unique_a, count_a + count_t),
    )
    return df.withColumns(dict(zip(FEATURES, values)))


def lexicon_features(
    df: DataFrame, lexicon: Sequence[str], abstract: str = "abstract", title: str = "title", phrases: bool = False
) -> DataFrame:
    """Add the six features for a word list that fits in the plan.

    Whole texts, no shuffle: each text is tokenised once and its hits are filtered from the
    token array. Absent text columns count as empty, so the output schema is always the same.
    Multi-word entries match only with ``phrases=True``.
    """
    lexicon = sorted({" ".join(w.split()).lower() for w in lexicon if w and w.strip()})

    def tokens(name: str) -> Column:
        return text.words(F.col(name)) if name in df.columns else F.lit(None).cast("array<string>")

    def length(c: Column) -> Column:
        return F.coalesce(F.array_size(c), F.lit(0))

    tokenised = df.withColumns({"_words_a": tokens(abstract), "_words_t": tokens(title)})
    found = tokenised.withColumns(
        {"_hits_a": _found(F.col("_words_a"), lexicon, phrases), "_hits_t": _found(F.col("_words_t"), lexicon, phrases)}
    )
    counted = found.withColumns(
        {
            "_count_a": length(F.col("_hits_a")),
            "_unique_a": length(F.array_distinct("_hits_a")),
            "_total_a": length(F.col("_words_a")),
            "_count_t": length(F.col("_hits_t")),
        }
    ).drop("_words_a", "_words_t", "_hits_a", "_hits_t")
    done = _finish(counted, F.col("_count_a"), F.col("_unique_a"), F.col("_total_a"), F.col("_count_t"))
    return done.drop("_count_a", "_unique_a", "_total_a", "_count_t")


def _tokens(
    df: DataFrame, key: str, texts: Sequence[str], lexicon: DataFrame, word: str, phrases: bool, firsts: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The list's entries (word), and the words of each text column (key, part, word, first).

    With ``firsts`` the distinct words of a text come once more, marked ``first``.
    """
    no_words = F.array().cast("array<string>")
    wanted = normalize_lexicon(lexicon, word).withColumnRenamed(word, "word").filter("word <> ''")
    longest = 1
    if phrases:
        longest = wanted.agg(F.max(F.size(F.split("word", " ")))).first()[0] or 1
    else:
        wanted = wanted.filter(~F.contains("word", F.lit(" ")))

    # Tokenised once: the words are columns of their own before anything refers to them.
    names = {name: f"_words_{i}" for i, name in enumerate(texts)}
    tokenised = df.select(F.col(key), *[F.coalesce(text.words(F.col(n)), no_words).alias(at) for n, at in names.items()])

    def occurrences(name: str, at: str) -> Column:
        runs = [F.col(at), *[text.word_runs(F.col(at), n) for n in range(2, longest + 1)]]
        every = F.concat(*runs)

        def rows(found: Column, first: bool) -> Column:
            return F.transform(found, lambda w: F.struct(F.lit(name).alias("part"), w.alias("word"), F.lit(first).alias("first")))

        return F.concat(rows(every, False), rows(F.array_distinct(every), True)) if firsts else rows(every, False)

    occurring = F.concat(*[occurrences(n, at) for n, at in names.items()])
    return wanted, tokenised.select(F.col(key), F.explode(occurring).alias("o")).select(key, "o.*")


def lexicon_hits(
    df: DataFrame,
    key: str,
    texts: Sequence[str],
    lexicon: DataFrame,
    word: str = "flagged_word",
    broadcast_rows: int = BROADCAST_ROWS,
    phrases: bool = False,
) -> DataFrame:
    """Per key and text column, how often each lexicon entry occurs; texts without a hit have no row.

    The form for a word list of any size. A list below the broadcast bound filters the words where the
    text is read. A longer one does so as a filter of its hashes, of bounded size: the few words that pass without being
    listed are left to the exact join. What passes is counted, so that a word goes on once per
    text however often the text repeats it, and the counts, written once, meet the list in the salted
    join. With ``phrases`` runs of words up to the longest entry count too. Rows of equal ``key`` are counted together.
    """
    wanted, tokens = _tokens(df, key, texts, lexicon, word, phrases)

    def count(found: DataFrame) -> DataFrame:
        return found.groupBy(key, "part", "word").agg(F.count(F.lit(1)).alias("n"))

    size = measure(wanted)
    if fits(size, broadcast_rows):
        return count(tokens.join(F.broadcast(wanted), "word", "left_semi"))
    # Past the broadcast bound the counts are read twice: written once, so that no text is.
    return lookup_join(written(count(_maybe_listed(tokens, wanted, size[0])), "word-counts"), wanted, ["word"], "left_semi", broadcast_rows)


def _maybe_listed(tokens: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """Tokens whose hash has its bit set in a filter over the list: all that are listed, and few others. No shuffle of them."""
    blocks = max(1, min(-(-n_wanted * LIST_BITS // BLOCK_BITS), MOST_BITS // BLOCK_BITS))
    block = F.pmod(F.xxhash64("word"), F.lit(blocks))
    at = F.pmod(F.xxhash64("word", F.lit(1)), F.lit(BLOCK_BITS)).cast("int")
    bits = wanted.groupBy(block.alias("_block")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    # A bit array per block, in words of 32 bits that a lookup can index.
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_BITS // 32 - 1)),
        lambda i: F.conv(F.hex(F.substring(F.col("_bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint"),
    )
    listed = written(bits.select("_block", words.alias("_words")), "list-bits")
    probed = tokens.withColumns({"_block": block, "_at": at}).join(F.broadcast(listed), "_block")
    byte = F.floor(F.col("_at") / 8)  # bytes go from high to low within a word, bits of a byte from low to high
    shift = ((3 - byte % 4) * 8 + F.col("_at") % 8).cast("int")
    word = F.get("_words", F.floor(F.col("_at") / 32).cast("int"))
    return probed.filter(F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1).select(*tokens.columns)


def lexicon_features_by_join(
    df: DataFrame,
    lexicon: DataFrame,
    abstract: str = "abstract",
    title: str = "title",
    word: str = "flagged_word",
    broadcast_rows: int = BROADCAST_ROWS,
    phrases: bool = False,
) -> DataFrame:
    """The same six features for a word list too long to inline.

    Features depend on the texts alone, so rows are told apart by a digest of their texts: no key
    has to be unique. Equal texts are counted together and their hits divided by the number of their rows, so that only
    digests and words are shuffled, never texts. Rows without text have no digest and no hit.
    """
    present = [c for c in (abstract, title) if c in df.columns]
    if not present:
        return lexicon_features(df, [], abstract, title)
    digest = F.md5(F.to_json(F.struct(*present)))
    marked = df.withColumn("_text", F.when(F.greatest(*[F.col(c).isNotNull() for c in present], F.lit(False)), digest))
    in_abstract, in_title = F.col("part") == abstract, F.col("part") == title
    texts = marked.select("_text", *present).filter("_text IS NOT NULL")
    copies = texts.groupBy("_text").agg(F.count(F.lit(1)).alias("_copies"))
    wanted, tokens = _tokens(texts, "_text", present, lexicon, word, phrases, firsts=True)
    if fits(measure(wanted), broadcast_rows):
        # Distinct words are marked per row, so that nothing is counted by text and word: a task holds a row per text.
        counts = {"_count_a": in_abstract & ~F.col("first"), "_unique_a": in_abstract & F.col("first"), "_count_t": in_title & ~F.col("first")}
        found = tokens.join(F.broadcast(wanted), "word", "left_semi")
        hits = found.groupBy("_text").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    else:
        counts = ("_count_a", "_count_t")
        found = lexicon_hits(texts, "_text", present, lexicon, word, broadcast_rows, phrases)
        hits = found.groupBy("_text").agg(
            F.sum(F.when(in_abstract, F.col("n"))).alias("_count_a"),
            F.count_if(in_abstract).alias("_unique_a"),
            F.sum(F.when(in_title, F.col("n"))).alias("_count_t"),
        )
    each = {c: F.call_function("div", F.col(c), F.col("_copies")) for c in counts}
    per_text = written(hits.join(copies, "_text").withColumns(each).drop("_copies"), "text-hits")
    # Counted before the join: only the digest is looked up.
    total = text.word_count(F.col(abstract)) if abstract in df.columns else F.lit(0)
    joined = lookup_join(marked.withColumn("_total_a", total), per_text, ["_text"], "left", broadcast_rows)
    filled = joined.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("int") for c in ("_count_a", "_unique_a", "_count_t")}
    )
    done = _finish(filled, F.col("_count_a"), F.col("_unique_a"), F.col("_total_a"), F.col("_count_t"))
    return done.select(*df.columns, *FEATURES)


def lexicon_coverage(df: DataFrame, flag: str = "has_flagged_words") -> DataFrame:
    """Rows with any hit over all rows."""
    return df.agg(F.count_if(F.col(flag)).alias("n_hit"), F.count(F.lit(1)).alias("n_rows"))
