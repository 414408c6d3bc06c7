"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

``X`` is the matrix of centred rows. Starting from a unit vector ``v``, the products ``X v`` and ``X' u`` alternate
and build orthonormal vectors ``u_j`` (as long as the table) and ``v_j`` (as long as a row) with ``U' X V`` bidiagonal:

    X v_j = beta_(j-1) u_(j-1) + alpha_j u_j,    X' u_j = alpha_j v_j + beta_j v_(j+1).

Both sides are reorthogonalised in full against all earlier vectors, and again as long as that changes them. No ``u`` is
ever stored: each is ``X w`` for a vector ``w`` as long as a row, so one pass over the rows gives for a candidate
``t = X w`` its products with all earlier ``u`` (each made again from ``w``), its length and ``X' t``. What the
reorthogonalisation takes from ``t`` is taken from these by linearity. The small bidiagonal matrix is decomposed
on the driver: its right singular vectors give the components, its singular values their deviations.

A step is one job: every task adds up its rows, sums meet by position (``dims + steps`` rows), and these few
numbers reach the driver. Steps go on until the wanted components have converged to double precision, at most one per
dimension. Where the sequence breaks off (rows of lower rank, equal deviations) it goes on from another direction.

Entries are whole numbers, ``floor(SCALE * c) + OFFSET``; sums and each row's squared deviation are exact.

Defined cases: a vector that is null or holds null or non-finite entries takes no part, nor does one whose
length is not the most frequent one (of equally frequent ones the least) or an entry whose whole number does not
fit in a long; null ids and repeated rows stay; a squared deviation that does not fit in a long is null; components
without deviation (rank below the number asked for, a single row, equal rows) cannot be whitened and are left out;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import only, slices, tidy, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
CONVERGED = 1e-14  # residual of a singular triple over the largest singular value
FLAT = 1e-12  # a deviation below this part of the largest is none
AGAIN = 1e-10  # share of a vector that a reorthogonalisation may take without being repeated
ROWS = 10_000


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x array<long>) of the rows that take part."""
    scaled = F.transform(F.col(vector_col), lambda c: c.cast("double") * scale)
    rows = vectors.select(F.col(id_col).alias("vec_id"), scaled.alias("c")).filter(
        F.coalesce(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 9e18)), F.lit(False)) & (F.size("c") > 0)
    )
    size = rows.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    dims = size["d"] if size else 0
    whole = F.transform("c", lambda c: F.floor(c).cast("long") + F.lit(offset).cast("long"))
    return rows.filter(F.size("c") == dims).select("vec_id", whole.alias("x"))


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the sum of each dimension."""
    sums = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    ).orderBy("i").collect()  # one row per dimension
    return (sums[0]["n"], [int(r["s"]) for r in sums]) if sums else (0, [])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n: the whole part of the mean is taken off exactly, the rest in double precision."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole).astype(float) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) ** 2 for each row, exact; None beyond a long."""
    limit, most = 2 ** 63, np.abs(x).max(initial=0) * float(n)
    gap = np.abs(x - np.array([s / n for s in sums])).max(initial=0) * n * 1.001 + n
    if max(most, *map(abs, sums)) < limit / 4 and gap ** 2 * x.shape[1] < limit / 2:
        gaps = n * x - np.array(sums, np.int64)
        return (gaps * gaps).sum(axis=1).tolist()
    found = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < limit else None for v in found]


class Rows:
    """The centred rows, and sums over them by position."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.sums, self.dims = rows, n, sums, len(sums)

    def total(self, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``add(block of centred rows)``, a flat array of fixed length, over all blocks."""
        n, sums = self.n, self.sums

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            only("whitening")
            found = None
            for batch in slices(batches, ROWS):
                if batch.num_rows:
                    part = add(centred(_matrix(batch.column(0)), n, sums))
                    found = part if found is None else found + part
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], names=["i", "v"])

        summed = self.rows.select("x").mapInArrow(tidy(task), "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
        return np.array([r["v"] for r in summed.orderBy("i").collect()])


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        b = np.array(basis)
        for _ in range(3):
            v = v - b.T @ (b @ v)
    return v


@dataclass
class Whitening:
    components: np.ndarray  # one unit column per component
    variances: np.ndarray
    trace: float
    n: int
    sums: list[int]
    steps: int

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.components / np.sqrt(self.variances))


def bidiagonalise(rows: Rows, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """(components as columns, singular values, steps): the ``wanted`` largest of the centred rows."""
    dims = rows.dims
    rng = np.random.default_rng(seed)

    def other_direction(v_list):
        v = _orthogonal(rng.standard_normal(dims), v_list)
        return v / np.linalg.norm(v)

    v_list = [other_direction([])]
    w_list, r_list, alphas, betas = [], [], [], []  # u_j = X w_j, r_j = X' u_j
    scale = 0.0
    while True:
        j = len(alphas)
        w = v_list[j] - (betas[-1] * w_list[-1] if j else 0.0)
        taken = np.zeros(j)
        for _ in range(3):
            basis = np.array(w_list).T.reshape(dims, j)

            def products(x, w=w, basis=basis):
                t = x @ w
                return np.concatenate([(x @ basis).T @ t, [t @ t], x.T @ t])

            found = rows.total(products)
            along, length, back = found[:j], found[j], found[j + 1:]
            w = w - basis @ along
            back = back - (np.array(r_list).T.reshape(dims, j) @ along)
            taken = np.linalg.norm(along)
            rest = max(length - taken ** 2, 0.0)
            if taken <= AGAIN * np.sqrt(length) or length <= (1e-14 * scale) ** 2:
                break
        alpha = np.sqrt(rest)
        scale = max(scale, alpha, betas[-1] if betas else 0.0)
        if alpha <= 1e-13 * scale or alpha == 0:
            alpha, w, back = 0.0, np.zeros(dims), np.zeros(dims)  # X v lies in what is there: the row of the bidiagonal is empty
        else:
            w, back = w / alpha, back / alpha
        alphas.append(alpha)
        w_list.append(w)
        r_list.append(back)
        following = _orthogonal(back - alpha * v_list[j], v_list)
        beta = float(np.linalg.norm(following))
        scale = max(scale, beta)
        small = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(small)
        if j + 1 >= dims:
            break
        broken = beta <= 1e-13 * scale
        residual = beta * np.abs(left[-1, :wanted])
        # A sequence that breaks off has found one direction of each deviation; equal ones need another start.
        if not broken and j + 1 >= wanted and residual.max() <= CONVERGED * values[0]:
            break
        betas.append(0.0 if broken else beta)
        v_list.append(other_direction(v_list) if broken else following / beta)
    return np.array(v_list).T @ right.T, values, len(alphas)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of a written table (vec_id, x); None without rows."""
    n, sums = exact_sums(rows)
    if not n:
        return None
    table = Rows(rows, n, sums)
    trace = float(table.total(lambda x: np.array([(x * x).sum()]))[0]) / n
    vectors, values, steps = bidiagonalise(table, min(components, len(sums)))
    variances = values ** 2 / n
    kept = [i for i in np.argsort(-values, kind="stable")[:components] if variances[i] > 0 and values[i] > FLAT * values.max()]
    return Whitening(vectors[:, kept], variances[kept], trace, n, sums, steps)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.variances)
    if not k:
        return 0.0
    table, scaled = Rows(rows, model.n, model.sums), model.components / np.sqrt(model.variances)
    mean = table.total(lambda x: (x @ scaled).sum(axis=0)) / model.n

    def products(x):
        z = x @ scaled - mean
        return (z.T @ z).ravel()

    return float(np.abs(table.total(products).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained): one row per row and component."""
    k = len(model.variances)
    share = model.variances / model.trace if model.trace else model.variances
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("whitening")
        for batch in slices(batches):
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column(1))
            each = pa.array(np.repeat(np.arange(batch.num_rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, model.n)), pa.array(deviations(x, model.n, model.sums), pa.int64()).take(each),
                pa.array(model.whitened(x).ravel()), pa.array(np.tile(share, len(x))),
            ], names=schema.names)

    return rows.select("vec_id", "x").mapInArrow(tidy(task), schema)


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Fit on all rows that take part and whiten them; with the error of the whole as ``identity_error``."""
    rows = written(whole_numbers(vectors, id_col, vector_col), "whole-numbers")
    model = fit(rows, components)
    if model is None:
        model = Whitening(np.zeros((0, 0)), np.zeros(0), 0.0, 0, [], 0)
    return whiten(rows, model).withColumn("identity_error", F.lit(identity_error(rows, model)))


def op11_whiten_embeddings(spark, sf_dir: str) -> DataFrame:
    return whitened_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
