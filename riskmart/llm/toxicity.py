"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

*Model.* ``P(grade > k) = sigmoid(w . x - t_k)`` with one weight vector shared by all thresholds
``t_1 < t_2 < ...``; thresholds are kept in order by fitting the first and the logarithms of the steps.
The expected severity is the sum of these probabilities, between 0 and the highest grade; a document is
rejected when ``P(grade > 0)`` reaches ``REJECT``.

*Features.* The distinct words of the whole text and their beginnings (``PREFIXES`` letters), hashed to 32
bits. A feature counts once per document, so a few words in a long text weigh what they weigh in a short
one. Of all features in the training sample the ``FEATURES`` that tell toxic from clean documents best (by a
signed likelihood ratio, pooled over the sample in a grouped count) enter the model.

*Grades.* The table says only toxic or not. Severity is graded from that: clean is 0; toxic documents are
1, 2 or 3 by thirds of the number of distinct features they hold that mark toxic documents.
``fit`` takes any ordered grades.

*Sample.* At most ``TOXIC_SAMPLE`` toxic and ``CLEAN_SAMPLE`` clean labelled documents of this table, those whose
ids hash lowest (labels of other documents take no place in it); a label is looked up by broadcasting these ids. Every document is then scored by its whole text.

Defined cases: a null or wordless text has only the constant, so severity is that of the base rate and it
stays; null labels and labels of unknown documents are not learned from; of several labels of a document
the highest counts; with no toxic or no clean label nothing is rejected and severity is 0; a null id comes
back; repeated rows each come back; an empty table gives an empty result; input columns named like an
output column are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import lowest, only, slices, tidy, without, written

TOXIC_SAMPLE = 2_000
CLEAN_SAMPLE = 6_000
FEATURES = 768
PREFIXES = (3, 4, 5)
GRADES = 4
REJECT = 0.5
RIDGE = 0.02
OUTPUT = ("severity", "p_toxic", "grade", "rejected")
_WORD = re.compile(r"\w+")
_CACHE = 150_000


def word_features(word: str) -> list[int]:
    """A word and its beginnings, as signed 32-bit hashes."""
    names = [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(n.encode()) - (1 << 31) for n in names]


def text_features(text: str | None) -> set[int]:
    found: set[int] = set()
    for word in set(_WORD.findall((text or "").lower())):
        found.update(word_features(word))
    return found


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * np.asarray(x, float)) + 0.5


@dataclass
class CumulativeLink:
    """Ordinal regression over a list of features; one weight each, shared by all thresholds."""

    features: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def above(self, score) -> np.ndarray:
        """P(grade > k) for every threshold, in a last dimension."""
        return _sigmoid(np.asarray(score, float)[..., None] - self.thresholds)


def fit(rows: list[np.ndarray], grades: np.ndarray, features: np.ndarray, levels: int = GRADES, steps: int = 300, rate: float = 0.1, ridge: float = RIDGE) -> CumulativeLink:
    """Maximum likelihood with a ridge on the weights, by Adam. ``rows``: positions of each document's features."""
    at = np.concatenate(rows) if rows else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    grades = np.asarray(grades)
    size = len(features) + levels - 1
    share = np.clip([(grades > k).mean() for k in range(levels - 1)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(levels - 1))
    p = np.concatenate([np.zeros(len(features)), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros(size), np.zeros(size)
    count = max(len(rows), 1)
    for step in range(1, steps + 1):
        weights, steps_up = p[:len(features)], np.exp(p[len(features) + 1:])
        cuts = p[len(features)] + np.concatenate([[0], np.cumsum(steps_up)])
        score = np.bincount(of, weights[at], len(rows))
        # Interval likelihood: grade g lies between the cuts g - 1 and g.
        low = np.concatenate([[-np.inf], cuts])[grades]
        high = np.concatenate([cuts, [np.inf]])[grades]
        f_low, f_high = _sigmoid(score - low), _sigmoid(score - high)
        inside = np.maximum(f_low - f_high, 1e-9)
        d_low, d_high = f_low * (1 - f_low), f_high * (1 - f_high)
        d_score = -(d_low - d_high) / inside / count
        gradient = np.zeros(size)
        gradient[:len(features)] = np.bincount(at, d_score[of], len(features)) + ridge * weights / count * 10
        d_cuts = np.zeros(levels - 1)
        np.add.at(d_cuts, (grades - 1)[grades > 0], (d_low / inside / count)[grades > 0])
        np.add.at(d_cuts, grades[grades < levels - 1], -(d_high / inside / count)[grades < levels - 1])
        gradient[len(features)] = d_cuts.sum()
        gradient[len(features) + 1:] = np.cumsum(d_cuts[::-1])[::-1][1:] * steps_up
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        p = p - rate * (1 - 0.9 * step / steps) * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    cuts = p[len(features)] + np.concatenate([[0], np.cumsum(np.exp(p[len(features) + 1:]))])
    return CumulativeLink(features, p[:len(features)], cuts)


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_sample: int, clean_sample: int) -> DataFrame:
    """(toxic, features) of the bounded sample of labelled documents."""
    present = docs.select(F.col(id_col).alias("id_")).filter("id_ is not null").distinct()
    judged = (
        labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col(id_col).alias("id_")).agg(F.max("toxic").cast("int").alias("toxic_"))
        .join(present, "id_", "left_semi").withColumn("h_", F.xxhash64("id_"))
    )
    judged = written(judged, "judged")
    sizes = dict(judged.groupBy((F.col("toxic_") > 0).alias("t")).agg(F.count(F.lit(1))).collect())
    some = lowest(judged.filter("toxic_ > 0"), "h_", toxic_sample, sizes.get(True, 0), "id_").union(
        lowest(judged.filter("toxic_ <= 0"), "h_", clean_sample, sizes.get(False, 0), "id_")
    )
    found = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_")).join(F.broadcast(some), "id_")
    # An id may repeat; one text stands for it, so that the sample stays bounded.
    chosen = found.groupBy("id_").agg(F.max("toxic_").alias("toxic_"), F.min("text_").alias("text_")).select("toxic_", "text_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("toxicity")
        for batch in slices(batches):
            found = [sorted(text_features(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "features"])

    return chosen.mapInArrow(tidy(run), "toxic int, features array<long>")


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE, features: int = FEATURES,
) -> CumulativeLink | None:
    """Choose features and fit on the bounded sample; None unless it has toxic and clean documents."""
    sample = written(_sampled(docs, labels, id_col, text_col, toxic_sample, clean_sample), "sample")
    totals = sample.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    toxic, clean = totals["toxic"] or 0, totals["all"] - (totals["toxic"] or 0)
    if not toxic or not clean:
        return None
    counted = (
        sample.select("toxic", F.explode("features").alias("f")).groupBy("f")
        .agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("t"), F.count(F.lit(1)).alias("n")).withColumn("c", F.col("n") - F.col("t"))
    )
    # Gain of telling the two apart, in nats per feature; features of one or two documents say nothing.
    rate_t, rate_c = (F.col("t") + 0.5) / (toxic + 1.0), (F.col("c") + 0.5) / (clean + 1.0)
    gain = F.col("t") * F.log(rate_t / rate_c) + F.col("c") * F.log(rate_c / rate_t)
    chosen = (
        counted.filter("n >= 3").withColumn("gain", gain).orderBy(F.desc("gain"), "f").limit(features)
        .select("f", F.log(rate_t / rate_c).alias("odds")).collect()
    )
    if not chosen:
        return None
    listed = np.sort(np.array([r["f"] for r in chosen], np.int64))
    odds = np.zeros(len(listed))
    odds[np.searchsorted(listed, [r["f"] for r in chosen])] = [r["odds"] for r in chosen]
    rows, labelled = [], []
    for r in _held(sample, listed).collect():
        rows.append(np.searchsorted(listed, np.sort(np.array(r["features"], np.int64))))
        labelled.append(r["toxic"] > 0)
    order = sorted(range(len(rows)), key=lambda i: (labelled[i], rows[i].tobytes()))  # the same fit whatever order they came in
    rows, labelled = [rows[i] for i in order], np.array([labelled[i] for i in order])
    return fit(rows, grade(rows, labelled, odds > 1.5), listed)


def _held(sample: DataFrame, listed: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [f[np.isin(f, listed)] for f in (np.array(x, np.int64) for x in batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k.tolist() for k in kept], pa.list_(pa.int64()))], names=["toxic", "features"])

    return sample.mapInArrow(tidy(run), "toxic int, features array<long>")


def grade(rows: list[np.ndarray], toxic: np.ndarray, marks: np.ndarray, levels: int = GRADES) -> np.ndarray:
    """0 for clean; toxic documents 1.. by equal shares of their number of marking features."""
    held = np.array([int(marks[r].sum()) for r in rows])
    grades = np.zeros(len(rows), int)
    if toxic.any():
        cuts = np.quantile(held[toxic], np.arange(1, levels - 1) / (levels - 1))
        grades[toxic] = 1 + np.searchsorted(cuts, held[toxic], side="left")
    return grades


def score(docs: DataFrame, model: CumulativeLink | None, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """All rows and columns with severity, p_toxic, grade and rejected, from the whole text."""
    base = without(docs, OUTPUT)
    if model is None:
        return base.select("*", F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(0).alias("grade"), F.lit(False).alias("rejected"))
    text_at = base.columns.index(text_col)
    schema = T.StructType([
        *base.schema.fields, T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
        T.StructField("grade", T.IntegerType()), T.StructField("rejected", T.BooleanType()),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("toxicity")
        weight_of = dict(zip(model.features.tolist(), model.weights.tolist()))
        cache: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches):
            scores = np.zeros(batch.num_rows)
            if len(cache) > _CACHE:
                cache.clear()
            for i, text in enumerate(batch.column(text_at)):
                known: set[int] = set()
                for word in set(_WORD.findall((text.as_py() or "").lower())):
                    found = cache.get(word)
                    if found is None:
                        found = cache[word] = tuple(f for f in word_features(word) if f in weight_of)
                    if found:
                        known.update(found)
                scores[i] = sum(weight_of[f] for f in sorted(known))
            above = model.above(scores)
            columns = [
                *batch.columns, pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(above[:, 0] >= reject),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return base.mapInArrow(tidy(run), schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, learn(docs, labels)).drop("text")
