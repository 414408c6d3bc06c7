"""Spelling variants: frequent words, their neighbours at one edit, and the form each word stands for.

*Words.* Letters of a text run by run; each task adds up the words of its rows and hands on at most
``HELD`` partial counts at a time, so that a word with a third of all occurrences is a few rows.

*Permuterm rotations.* A word ``x c y`` marked with a terminator has the rotation ``y $ x c``. Its prefix
``y $ x`` leaves the edited character out: every other word that continues the same prefix by one character
differs by a replacement there, and the word whose own rotation is the prefix differs by an insertion or
deletion. So all rotations are sorted, each under its prefix without the last character and each word once
more under its whole rotations, and the prefix ranges are scanned. A range holds one word per letter of the alphabet
and one shorter word at most (``LETTERS`` + 1 rows), whatever the words: no group can be hot. A character out
of a run of equal ones can be deleted in several ways; only the first counts, so that every pair of near
words meets exactly once, and counts need no list of pairs. The scan hands on, for each word of a range, the number of its
neighbours there and the best of them.

Words are replaced by their place in the sorted word list: a number that keeps the order of code points.
Prefixes of more than ``LONG`` characters are replaced by a 127-bit polynomial hash that is rolled along the
word, so that a word of a million letters costs a million small rows and not their square.

*Roots.* Forms point to ever larger counts (at least twice as large), so chains are shorter than the
logarithm of the largest count, and doubling the pointers a fixed number of times ends them.

Defined cases: a null text has no words; a null id is written as nothing before the colon; repeated rows
count as often as they occur; ties go to the smaller word in code-point order; texts of any length are read
whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import only, tidy, written

# Letters of a word, what is deleted, and the least length, count and ratio.
LETTERS = 26 + 64
DIVISOR = 97
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2

LONG = 64
HELD = 400_000
END = "\t"  # the terminator: no letter, and below all of them
_MODULUS = (1 << 127) - 1
_BASE = 0x5DEECE66D5DEECE66D5DEECE66D5DEEB % _MODULUS
# Latin-1 bytes: letters stay, A-Z become small, all else parts words.
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256))


def runs_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split(b" ")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("spelling")
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        made = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return made

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            counts = Counter(runs_of(text.as_py() or ""))
            counts.pop(b"", None)
            for word, n in counts.items():
                h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                if h % DIVISOR == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                if len(word) >= MIN_LENGTH:
                    held[word] += n
            if len(held) >= HELD:
                yield out()
    if held:
        yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    counted = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(_count), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def rolled(word: str) -> Iterator[tuple[str, int, bool]]:
    """(prefix, position or -1, first of its run) of a long word's rotations: whole ones, and those that skip a character."""
    size = len(word)
    powers, heads = [1], [0]
    for c in word:
        powers.append(powers[-1] * _BASE % _MODULUS)
        heads.append((heads[-1] * _BASE + ord(c)) % _MODULUS)

    def name(i: int, j: int) -> str:  # word[j:] + END + word[:i]
        tail = (heads[size] - heads[j] * powers[size - j]) % _MODULUS
        found = ((tail * _BASE + ord(END)) * powers[i] + heads[i]) % _MODULUS
        return f"{END}{size - j + i}{END}{i}{END}{found:x}"

    if size > LONG:
        for i in range(size + 1):
            yield name(i, i), -1, True
    if size > LONG + 1:
        for i in range(size):
            yield name(i, i + 1), i, i == 0 or word[i] != word[i - 1]


def _roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["prefix", "skips", "first", "place", "n"]
    for batch in batches:
        for place, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            waiting = []
            for prefix, at, first in rolled(word):
                waiting.append((prefix, at >= 0, first, place, n))
                if len(waiting) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*waiting)], names=names)
                    waiting = []
            if waiting:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*waiting)], names=names)


def rotations(words: DataFrame) -> DataFrame:
    """(place, word, n) -> (prefix, skips, first, place, n): each rotation whole, and without its last character."""
    def prefix(i: Column, j: Column) -> Column:
        return F.concat(F.substring("word", j + 1, F.lit(LONG + 2)), F.lit(END), F.substring("word", F.lit(1), i))

    size = F.length("word")
    whole = F.when(size <= LONG, F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        prefix(i, i).alias("prefix"), F.lit(False).alias("skips"), F.lit(True).alias("first"))))
    skipping = F.when(size <= LONG + 1, F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        prefix(i, i + 1).alias("prefix"), F.lit(True).alias("skips"),
        ((i == 0) | (F.substring("word", i, F.lit(1)) != F.substring("word", i + 1, F.lit(1)))).alias("first"))))
    none = F.array().cast("array<struct<prefix: string, skips: boolean, first: boolean>>")
    made = F.concat(F.coalesce(whole, none), F.coalesce(skipping, none))
    short = words.filter(size <= LONG + 1).select("place", "n", F.explode(made).alias("r")).select("r.*", "place", "n")
    long = words.filter(size > LONG).select("place", "word", "n").mapInArrow(tidy(_roll), short.schema)
    return short.union(long)


def neighbours(turned: DataFrame) -> DataFrame:
    """Scan the prefix ranges: (place, n_near, best) with one row per word that has neighbours; best is {n, place} with the place negated."""
    everyone = Window.partitionBy("prefix")
    ranked = everyone.orderBy(F.desc("n"), "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct("n", (-F.col("place")).alias("place"))
    skips, droppable = F.col("skips"), F.col("skips") & F.col("first")
    scanned = turned.withColumn("in_range", F.count(F.lit(1)).over(everyone)).filter("in_range > 1").select(
        "*",
        F.count_if(skips).over(everyone).alias("n_skip"),
        F.count_if(droppable).over(everyone).alias("n_drop"),
        F.max(F.when(~skips, me)).over(everyone).alias("whole"),
        F.nth_value(F.when(skips, me), 1, True).over(ranked).alias("top"),
        F.nth_value(F.when(skips, me), 2, True).over(ranked).alias("second"),
        F.nth_value(F.when(droppable, me), 1, True).over(ranked).alias("top_drop"),
    )
    other = F.when(F.col("top.place") == -F.col("place"), F.col("second")).otherwise(F.col("top"))
    whole = F.when(F.col("first"), F.col("whole"))
    found = scanned.select(
        "place",
        F.when(skips, F.col("n_skip") - 1 + whole.isNotNull().cast("int")).otherwise(F.col("n_drop")).alias("near"),
        F.when(skips, F.greatest(other, whole)).otherwise(F.col("top_drop")).alias("best"),
    ).filter("near > 0")
    return found.groupBy("place").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n) -> word, form, root, n, n_near, form_n."""
    listed = written(words, "words")
    # Partitions of a global sort follow one another, and so do the ids given in it.
    placed = written(listed.orderBy("word").withColumn("place", F.monotonically_increasing_id()), "placed")
    near = neighbours(rotations(placed))
    best = placed.join(near, "place", "left").select(
        "word", "place", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best")).alias("best"),
    )
    best = written(best.select("word", "place", "n", "n_near", (-F.col("best.place")).alias("to"), F.col("best.n").alias("form_n")), "forms")
    pointers = best.filter("to is not null").select("place", "to")
    largest = placed.agg(F.max("n")).first()[0] or 1
    for i in range(_doublings(largest, ratio)):
        onward = pointers.select(F.col("place").alias("to"), F.col("to").alias("next"))
        pointers = written(pointers.join(onward, "to", "left").select("place", F.coalesce("next", "to").alias("to")), f"roots-{i}")
    names = placed.select("place", "word")
    form = names.select(F.col("place").alias("to"), F.col("word").alias("form"))
    root = pointers.join(names.withColumnRenamed("place", "to"), "to").select("place", F.col("word").alias("root"))
    return (
        best.join(form, "to", "left").join(root, "place", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def _doublings(largest: int, ratio: int) -> int:
    """How often pointers must double to reach the end of any chain of counts that grow by ``ratio`` up to ``largest``."""
    steps = 0
    while ratio ** (1 << steps) <= largest:
        steps += 1
    return steps


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
