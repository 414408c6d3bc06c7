"""Word-level text expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of Unicode letters, digits and underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def words(c: Column) -> Column:
    """Lower-case words of a text, in order; null stays null."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), F.lit(0))


def word_count(c: Column) -> Column:
    """Number of words without building the array."""
    return F.coalesce(F.regexp_count(F.lower(c), F.lit(WORD_PATTERN)), F.lit(0))


def hits(tokens: Column, lexicon: Iterable[str]) -> Column:
    """The tokens that are lexicon words, repeats kept."""
    wanted = sorted(set(lexicon))
    if not wanted:
        return F.array().cast("array<string>")
    return F.filter(tokens, lambda w: w.isin(*wanted))


def word_runs(tokens: Column, length: int) -> Column:
    """The runs of ``length`` consecutive tokens, joined by a space; none for a null array.

    Runs grow by one token at a time, from whole arrays side by side: nothing inside a lambda refers to
    ``tokens``, which would be evaluated for every word again. Linear in the words.
    """
    runs = tokens
    for n in range(2, length + 1):
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        runs = F.zip_with(
            F.slice(runs, F.lit(1), count), F.slice(tokens, F.lit(n), count), lambda run, word: F.concat_ws(" ", run, word)
        )
    return F.coalesce(runs, F.array().cast("array<string>"))


def phrase_hits(tokens: Column, phrases: Iterable[str], length: int) -> Column:
    """The runs of ``length`` tokens that spell a lexicon phrase."""
    wanted = sorted(set(phrases))
    return F.filter(word_runs(tokens, length), lambda w: w.isin(*wanted))
