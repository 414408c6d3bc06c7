"""Nearest neighbours by cosine: inverted lists, scanned with an adaptive number of dimensions.

*Index.* Vectors are scaled to length 1 and rotated at random, so that any prefix of their dimensions
is a fair sample of the squared distance. Coarse centres are fitted by k-means on a bounded sample
(``SAMPLE_PER_LIST`` vectors for each of at most ``MAX_LISTS`` lists); every vector is put in the list of
its nearest centre. Equal vectors are stored once, with the ``k + 1`` least of their ids, which are all that
any result can need: a vector that a third of the table repeats costs no more than another one.

*Search.* A query probes its ``probe`` nearest lists. In each, vectors lie in column blocks of ``COLUMNS``
dimensions. The first rows are measured in full and set a threshold; the others are measured block by
block, and after ``d`` of ``D`` dimensions a vector is abandoned if its partial distance, scaled by
``D / d``, exceeds the threshold by more than the test allows (``(1 + EPSILON / sqrt(d)) ** 2``). The
threshold tightens after every ``CHUNK`` rows. Survivors are scored by the exact cosine of the original
vectors in double precision, and each query's best are ranked.

``PROBE_SHARE`` suits vectors without any cluster structure, where near neighbours lie in many lists (over
half must be read for a recall of 0.95); on clustered vectors pass a far smaller ``probe``.

Lists are split by a hash into parts of about ``PART`` vectors, and the queries of a list into parts of
about ``QUERY_PART``; a task holds one part of each. A list with a third of all vectors is so many parts.
Only the centres and the list sizes (at most ``MAX_LISTS`` rows) and the sample reach the driver. Scores of rows
against all centres, on the driver and in tasks, are made and used ``SCORES`` at a time.

Defined cases: a vector that is null, zero, of another length than most, or holds null or non-finite
components takes no part, nor does one without id; of rows that repeat an id the least vector counts; ties
go to the smaller id; a query finds all candidates if there are fewer than ``k`` in its lists; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import lowest, written

MAX_LISTS = 4_096
SAMPLE_PER_LIST = 40
ROUNDS = 10
PROBE_SHARE = 0.55
MIN_PROBE = 24
COLUMNS = 16
EPSILON = 1.5
SEEDS = 64
CHUNK = 1_024
PART = 4_096
QUERY_PART = 1_024
#: Values of a matrix of scores, 16 MB.
SCORES = 1 << 21


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part; one vector per id."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = (
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(good)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    dims = size[0]["d"] if size else 0
    return rows.filter(F.size("v") == dims).groupBy("vec_id").agg(F.min("v").alias("v"))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # first to at most 1, so that squares neither overflow nor vanish
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _sampled(column: pa.ChunkedArray, spread: np.ndarray) -> np.ndarray:
    """The collected vectors, scaled and rotated."""
    found, start = np.empty((len(column), len(spread))), 0
    for chunk in column.chunks:
        if len(chunk):
            found[start:start + len(chunk)] = _unit(_matrix(chunk)) @ spread
            start += len(chunk)
    return found


def fit_centres(sample: np.ndarray, lists: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """k-means on unit vectors; an empty centre takes the sample's farthest point."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        label, best = np.empty(len(sample), np.int64), np.empty(len(sample))
        half = (centres * centres).sum(axis=1) / 2
        for at in _pieces(len(sample), lists):
            near = sample[at] @ centres.T - half
            label[at], best[at] = near.argmax(axis=1), near.max(axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(label, minlength=lists)
        np.add.at(sums, label, sample)
        centres = sums / np.maximum(counts, 1)[:, None]
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            centres[empty] = sample[np.argsort(best)[:len(empty)]]
    return centres


def _pieces(rows: int, width: int) -> Iterator[slice]:
    """Runs of rows that have at most about ``SCORES`` values of ``width`` each."""
    step = max(1, SCORES // max(1, width))
    for start in range(0, rows, step):
        yield slice(start, min(start + step, rows))


def _matrix(column: pa.Array) -> np.ndarray:
    dims = len(column[0])
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _ranked(rotated: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    score = rotated @ centres.T - (centres * centres).sum(axis=1) / 2
    if count >= centres.shape[0]:
        return np.argsort(-score, axis=1)
    near = np.argpartition(-score, count - 1, axis=1)[:, :count]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(score, near, 1), axis=1), 1)


def _assign(spread: np.ndarray, centres: np.ndarray):
    """A task that gives each vector its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in _pieces(batch.num_rows, len(centres)):
                some = batch.slice(at.start, at.stop - at.start)
                label = _ranked(_unit(_matrix(some.column(0))) @ spread, centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(label.astype(np.int32))], names=["v", "ids", "list"])

    return run


def _choose(spread: np.ndarray, centres: np.ndarray, probe: int):
    """A task that copies each query to its nearest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in _pieces(batch.num_rows, len(centres) + probe * len(spread)):  # scores, and copies of the vector
                some = batch.slice(at.start, at.stop - at.start)
                near = _ranked(_unit(_matrix(some.column(1))) @ spread, centres, probe).astype(np.int32)
                copy = pa.array(np.repeat(np.arange(some.num_rows), near.shape[1]))
                yield pa.RecordBatch.from_arrays([some.column(0).take(copy), some.column(1).take(copy), pa.array(near.ravel())], names=["query_id", "v", "list"])

    return run


def adaptive_scan(queries: np.ndarray, blocks: list[np.ndarray], keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs that may be among the ``keep`` nearest rows of each rotated query; ``blocks`` hold the columns."""
    rows = blocks[0].shape[0]
    bounds = np.cumsum([0] + [b.shape[1] for b in blocks])
    dims = bounds[-1]
    parts = [np.ascontiguousarray(queries[:, a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    lengths = [(b * b).sum(axis=1) for b in blocks]
    query_lengths = [(q * q).sum(axis=1) for q in parts]

    def block_distance(i: int, start: int, end: int) -> np.ndarray:
        return query_lengths[i][:, None] + lengths[i][None, start:end] - 2 * (parts[i] @ blocks[i][start:end].T)

    seeds = min(max(SEEDS, keep), rows)
    first = sum(block_distance(i, 0, seeds) for i in range(len(blocks)))
    order = np.argsort(first, axis=1, kind="stable")[:, :keep]
    found, best = order, np.take_along_axis(first, order, 1)
    for start in range(seeds, rows, CHUNK):
        limit = best[:, -1] if best.shape[1] >= keep else np.full(len(queries), np.inf)
        distance = block_distance(0, start, min(start + CHUNK, rows))
        q, r = np.nonzero(distance * (dims / bounds[1]) <= _allowed(limit, bounds[1], dims)[:, None])
        distance = distance[q, r]
        r = r + start
        for i in range(1, len(blocks)):
            distance = distance + query_lengths[i][q] + lengths[i][r] - 2 * np.einsum("ij,ij->i", parts[i][q], blocks[i][r])
            stay = distance * (dims / bounds[i + 1]) <= _allowed(limit, bounds[i + 1], dims)[q]
            q, r, distance = q[stay], r[stay], distance[stay]
        if len(q):
            found, best = _merge(found, best, q, r, distance, keep)
    asked = np.repeat(np.arange(len(queries)), found.shape[1])
    real = found.ravel() >= 0
    return asked[real], found.ravel()[real]


def _allowed(limit: np.ndarray, d: int, dims: int) -> np.ndarray:
    """The largest scaled partial distance after ``d`` dimensions that the test does not reject."""
    slack = (1 + EPSILON / np.sqrt(d)) ** 2 if d < dims else 1.0
    return limit * slack + 1e-9


def _merge(found, best, q, r, distance, keep):
    """Each query's ``keep`` smallest of what it holds and what came in; ties stay with the earlier row."""
    count, width = found.shape
    every_q = np.concatenate([np.repeat(np.arange(count), width), q])
    every_r = np.concatenate([found.ravel(), r])
    every_d = np.concatenate([best.ravel(), distance])
    order = np.lexsort((every_r, every_d, every_q))
    every_q, every_r, every_d = every_q[order], every_r[order], every_d[order]
    nth = np.arange(len(every_q)) - np.searchsorted(every_q, every_q)
    kept = nth < keep
    rows, dists = np.full((count, keep), -1), np.full((count, keep), np.inf)
    rows[every_q[kept], nth[kept]] = every_r[kept]
    dists[every_q[kept], nth[kept]] = every_d[kept]
    return rows, dists


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision, each pair by itself, so that equal vectors have equal scores."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _search(spread: np.ndarray, keep: int):
    """Scan one part of a list for one part of its queries."""
    import pandas as pd

    def run(index, queries):
        if not len(index) or not len(queries):
            return pd.DataFrame({"query_id": [], "score": [], "ids": []})
        index = index.sort_values("first")
        rows = np.stack(index["v"].to_numpy())
        rotated = _unit(rows) @ spread
        blocks = [np.ascontiguousarray(rotated[:, i:i + COLUMNS]) for i in range(0, rotated.shape[1], COLUMNS)]
        asked = np.stack(queries["v"].to_numpy())
        q, r = adaptive_scan(_unit(asked) @ spread, blocks, keep)
        return pd.DataFrame({
            "query_id": queries["query_id"].to_numpy()[q], "score": cosine(rows[r], asked[q]), "ids": index["ids"].to_numpy()[r],
        })

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    probe: int | None = None,
    lists: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` to each row of ``queries``."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    base = written(usable(vectors, id_col, vector_col), "vectors")
    count = base.count()
    if not count:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    least = Window.partitionBy("v").orderBy("vec_id")
    distinct = (
        base.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    distinct = written(distinct, "distinct")
    lists = lists or int(min(MAX_LISTS, max(1, 2 * count ** 0.5)))
    picked = lowest(distinct.select("v", F.xxhash64("v").alias("h")), "h", lists * SAMPLE_PER_LIST, count).select("v").toArrow().column("v")
    spread = rotation(len(picked[0]))
    sample = _sampled(picked, spread)
    del picked
    lists = min(lists, len(sample))
    centres = fit_centres(sample, lists)
    probe = min(lists, probe or max(MIN_PROBE, int(lists * PROBE_SHARE)))

    index = written(distinct.select("v", "ids").mapInArrow(_assign(spread, centres), f"v array<double>, ids array<{id_type}>, list int"), "index")
    asked = base.join(queries.select(F.col(id_col).alias("vec_id")).distinct(), "vec_id", "left_semi")
    probed = written(asked.select(F.col("vec_id").alias("query_id"), "v").mapInArrow(_choose(spread, centres, probe), f"query_id {id_type}, v array<double>, list int"), "probes")
    parts = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("a"))
    query_parts = probed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_PART).cast("int").alias("b"))
    grid = F.broadcast(parts.join(query_parts, "list"))  # at most MAX_LISTS rows
    left = (
        index.join(grid, "list").withColumn("i", F.pmod(F.xxhash64("v"), "a").cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b") - 1))).select("list", "i", "j", "v", "ids", F.col("ids")[0].alias("first"))
    )
    right = (
        probed.join(grid, "list").withColumn("j", F.pmod(F.xxhash64("query_id"), "b").cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("a") - 1))).select("list", "i", "j", "query_id", "v")
    )
    hits = left.groupBy("list", "i", "j").cogroup(right.groupBy("list", "i", "j")).applyInPandas(
        _search(spread, k + 1), f"query_id {id_type}, score double, ids array<{id_type}>"
    )
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_nearest_vectors(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))
