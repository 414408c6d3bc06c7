"""Small tables with every odd case, for the tests of this folder."""

from __future__ import annotations

LONG = "der Hund und die Katze " * 20_000

# id, text, lang, source, n_chars and columns whose names an operator writes or uses itself
DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, rank int, text_sha256 int, block_ long, key_ string"


def odd_documents(spark):
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a"),
        (2, "one two three four five six seven eight nine ten", "en", "b"),
        (3, "ONE two three four five six seven eight nine ten", "en", None),
        (4, "", "en", "a"),
        (5, None, None, None),
        (6, " \n\t ", "de", "b"),
        (7, LONG, "de", "a"),
        (7, LONG, "de", "a"),  # a repeated row
        (8, "few words", None, "c"),
        (8, "other text with the same id as another row", "fr", "c"),
        (None, "no id here but quite some words to read in it", "en", "a"),
        (None, "no id here but quite some words to read in it", "en", "a"),
        (10, "été 日本 <|endoftext|> don't 12,5", "fr", "é"),
        (11, "12 34 -- !!", "en", ""),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", 1, 2, 3, "z") for r in rows], DOCS_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)
