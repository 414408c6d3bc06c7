"""Quality rules with compression bands.

A text is compressed by zstandard as a whole and in fixed chunks of ``CHUNK`` bytes; the ratio is compressed over
plain bytes. Repetitive text compresses far below prose of the same length, text without structure (keys, encoded
data, noise) hardly at all. What is usual depends on the length, as short texts share little with themselves, so
each length class of ``BANDS`` has its own least and largest ratio. A document is rejected if the whole lies outside
its band (copies of one line over a long text show here), or if chunks outside theirs hold more than ``BAD_SHARE`` of its
bytes (a junk part in a long text shows here, which the whole would average away). A last piece of less than half a
chunk belongs to the chunk before it.

Base rules come first: too few words, or too many words in three-word windows that repeat within the text.

One pass, no shuffle; a task holds one slice of an Arrow batch, and a long text by itself. Limits are fixed
parameters, alike for every table: a document's verdict never depends on other documents.

Defined cases: a null text is empty; an empty text has no words and fails the base rules; texts shorter than the first
class of ``BANDS`` have no band; texts of any length are read whole; repeated rows each come back; null ids come back; other
columns are not returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import only, slices, tidy

#: Bytes from which a class begins, its least and its largest ratio.
BANDS = ((128, 0.30, 1.05), (256, 0.30, 0.90), (512, 0.25, 0.82), (1_024, 0.22, 0.75), (4_096, 0.20, 0.70), (16_384, 0.18, 0.66), (65_536, 0.16, 0.65))
CHUNK = 4_096
BAD_SHARE = 1 / 3
LEVEL = 3
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\v\f\r"


def band_of(size: int, bands: Sequence[tuple[int, float, float]] = BANDS) -> tuple[float, float]:
    """Least and largest ratio for a text of so many bytes."""
    found = (0.0, float("inf"))
    for start, low, high in bands:
        if size >= start:
            found = (low, high)
    return found


def chunks_of(data: bytes, chunk: int = CHUNK) -> list[bytes]:
    """The whole text in chunks; a last piece of less than half a chunk goes with the one before."""
    cuts = list(range(0, len(data), chunk)) or [0]
    if len(cuts) > 1 and len(data) - cuts[-1] < chunk // 2:
        cuts.pop()
    return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]


class Bands:
    """Verdicts by compression."""

    def __init__(self, bands=BANDS, chunk: int = CHUNK, bad_share: float = BAD_SHARE, level: int = LEVEL):
        import zstandard

        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._bands, self._chunk, self._bad_share = bands, chunk, bad_share

    def _outside(self, data: bytes) -> tuple[float, bool]:
        low, high = band_of(len(data), self._bands)
        ratio = len(self._compress(data)) / len(data) if data else 1.0
        return ratio, not low <= ratio <= high

    def verdict(self, data: bytes) -> tuple[float, float, bool]:
        """Ratio of the whole, share of its bytes in chunks outside their band, and whether the text passes."""
        ratio, outside = self._outside(data)
        chunks = chunks_of(data, self._chunk)
        if len(chunks) == 1:
            return ratio, float(outside), not outside
        bad = sum(len(c) for c in chunks if self._outside(c)[1]) / len(data)
        return ratio, bad, not outside and bad <= self._bad_share


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    pairs = ids[:-1] * len(numbers) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:len(words) - 2 + shift] |= again
    return int(inside.sum())


def base_counts(text: str, data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; ``data`` is the text in UTF-8."""
    words = data.split()  # ASCII white space: 0x20 and 0x09 to 0x0D
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line in seen:
            duplicates += 1
        elif line.strip(_SPACE):
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words),
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Counts, ratios and verdicts of every document; ``limits`` are those of :class:`Bands`."""
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *[T.StructField(n, T.LongType()) for n in longs],
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
        T.StructField("ratio", T.DoubleType()), T.StructField("bad_share", T.DoubleType()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("quality")
        bands = Bands(**limits)
        for batch in slices(batches):
            counts, verdicts = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                data = text.encode()
                found = base_counts(text, data)
                failed = found[0] < MIN_WORDS or 100 * found[4] > MAX_REPEATED * found[0]
                ratio, bad, passes = bands.verdict(data)
                counts.append(found)
                verdicts.append((failed, passes and not failed, ratio, bad))
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else [[]] * 5)]
            kinds = (pa.bool_(), pa.bool_(), pa.float64(), pa.float64())
            columns += [pa.array(c, k) for c, k in zip(zip(*verdicts) if verdicts else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(task), schema)


def op13_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
