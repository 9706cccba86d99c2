"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (n x d) are never held anywhere: they stay a written table.
The recurrence alternates u = Xv and v = X'u, each made orthogonal to all
earlier ones; after d steps X V = U B with an upper bidiagonal B, whose small
singular value decomposition gives the components (V times its right vectors)
and the deviations (its singular values over the root of n).

One pass over the rows makes both products of a step. The left vectors have an
entry a row and are not stored: u = X z for a known z of d entries, so an entry
is a row's product with z, and an executor that is lost costs only its part of
a pass. Products of left vectors need no pass either: u_j . Xv = (X'u_j) . v,
and X'u_j is kept. So the full reorthogonalisation of both sides (twice, as
Gram-Schmidt needs) is arithmetic on d entries a step in the driver. The
driver holds three d x d matrices, nothing that grows with the rows; tasks send
d + 1 sums.

The recurrence runs through all d dimensions instead of stopping when the
leading values have settled: where a product vanishes (repeated or zero
eigenvalues) it goes on from a new direction, so no copy of a repeated
eigenvalue is missed.

Entries are quantised as floor(64 c); the constant 1,000,000 that the contract
adds changes neither a difference nor a covariance and is left out. Sums are
exact integers.

Defined cases: a null vector, or one with a null or non-finite entry, has no
result; of vectors of different lengths those of the most frequent length
(then the longest) count, the others have none; repeated rows and ids are rows of
their own; equal eigenvalues share a plane, in which any base is right;
components without variance cannot be whitened and have no rows, so an empty
table, a single row or equal rows give none. Deviations that exceed a 64-bit
integer raise an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import table
from churnlens.session import materialize

SCALE = 64
#: Eigenvalues below this part of the largest are rounding, not variance.
NO_VARIANCE = 1e-13


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is whole and of the common length, written once."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = materialize(rows.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("x")), "whitening_rows")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    return rows.where(F.size("x") == (lengths[0]["d"] if lengths else 0))


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), d)


def _exact_moments(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(d, object), np.zeros(d, object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if not len(x):
                continue
            n += len(x)
            # in machine integers where they hold the sum, else in Python's
            wide = float(np.abs(x.astype(float)).max()) ** 2 * len(x) >= 2.0 ** 62
            y = x.astype(object) if wide else x
            sums += y.sum(0).astype(object)
            squares += (y * y).sum(0).astype(object)
        if n:
            whole = pa.decimal128(38, 0)
            yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)), pa.array([n] * d, pa.int64()),
                                   pa.array([Decimal(int(s)) for s in sums], whole), pa.array([Decimal(int(s)) for s in squares], whole)],
                                  names=["i", "n", "s", "q"])
    return run


def _summed(x: DataFrame, values: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """The sum over all rows of ``values`` (a vector for a block of rows), one partial sum a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = values(_matrix(batch.column(0), d).astype(float))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    rows = x.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])])


def bidiagonalise(gram: Callable[[np.ndarray], tuple[float, np.ndarray]], d: int, size: float, steps: int | None = None,
                  seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(V with a right vector a row, upper bidiagonal B) of rows X given by ``gram``: y -> (|Xy|^2, X'Xy).

    ``size`` is the Frobenius norm of X. ``steps``: right vectors to make, by default all d.
    """
    rng = np.random.default_rng(seed)
    small = 1e-13 * size
    right, z, back = np.zeros((0, d)), np.zeros((0, d)), np.zeros((0, d))
    main, above = [], []

    def fresh() -> np.ndarray:
        v = rng.normal(size=d)
        for _ in range(3):
            v = v - right.T @ (right @ v)
            v /= np.linalg.norm(v)
        return v

    v = fresh()
    steps = min(d, steps or d)
    while True:
        right = np.vstack([right, v])
        # u = Xv less its parts along the earlier left vectors, as X times a vector of d entries
        y = v - z.T @ (back @ v)
        square, t = gram(y)
        again = z @ t
        y, t, square = y - z.T @ again, t - back.T @ again, square - again @ again
        alpha = float(np.sqrt(max(square, 0.0)))
        if alpha <= small:  # v is a direction without variance
            alpha, y, t = 0.0, np.zeros(d), np.zeros(d)
        else:
            y, t = y / alpha, t / alpha
        z, back = np.vstack([z, y]), np.vstack([back, t])
        main.append(alpha)
        if len(main) == steps:
            break
        v = t - alpha * v
        for _ in range(2):
            v = v - right.T @ (right @ v)
        beta = float(np.linalg.norm(v))
        if beta <= small:
            beta, v = 0.0, fresh()
        else:
            v = v / beta
        above.append(beta)
    return right, np.diag(main) + np.diag(above, 1)


@dataclass(frozen=True)
class Whitening:
    """``components``: a unit vector a row, by falling ``eigenvalues``; ``sums`` and ``n`` are exact."""
    n: int
    sums: list[int]
    trace: float
    components: np.ndarray
    eigenvalues: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def axes(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)[:, None]


def fit_whitening(x: DataFrame, components: int = 32, seed: int = 11) -> Whitening | None:
    """Leading components of the rows of ``quantised``; None where nothing varies."""
    head = x.select(F.size("x")).head(1)
    d = head[0][0] if head else 0
    if not d:
        return None
    exact = x.select("x").mapInArrow(_exact_moments(d), "i int, n long, s decimal(38,0), q decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    exact = sorted(exact, key=lambda r: r["i"])
    n, sums = exact[0]["n"], [int(r["s"]) for r in exact]
    spread = sum(n * int(r["q"]) - s * s for r, s in zip(exact, sums))  # n^2 times the trace
    if spread == 0:
        return None
    trace = spread / (n * n)
    mean = np.array([s / n for s in sums])

    def gram(y: np.ndarray) -> tuple[float, np.ndarray]:
        def both(rows: np.ndarray) -> np.ndarray:
            rows = rows - mean
            u = rows @ y
            return np.append(rows.T @ u, u @ u)
        total = _summed(x, both, d)
        return float(total[-1]), total[:-1]

    right, b = bidiagonalise(gram, d, (trace * n) ** 0.5, seed=seed)
    _, singular, turns = np.linalg.svd(b)
    values = singular ** 2 / n
    kept = min(components, int((values > NO_VARIANCE * values[0]).sum()))
    found = turns[:kept] @ right
    found *= np.sign(found[np.arange(kept), np.abs(found).argmax(1)])[:, None]
    axes = found / np.sqrt(values[:kept])[:, None]

    def products(rows: np.ndarray) -> np.ndarray:
        w = (rows - mean) @ axes.T
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    total = _summed(x, products, d)
    middle = total[kept * kept:] / n
    error = np.abs(total[:kept * kept].reshape(kept, kept) / n - np.outer(middle, middle) - np.eye(kept)).max()
    return Whitening(n, sums, trace, found, values[:kept], float(error))


def _whitened(fit: Whitening):
    d, n, sums, mean, axes = len(fit.sums), fit.n, np.array(fit.sums, object), fit.mean, fit.axes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), d)
            if not len(x):
                continue
            reach = n * int(np.abs(x.astype(float)).max()) + max(abs(s) for s in sums)
            if reach < 2 ** 62 and d * reach * reach < 2 ** 62:
                off = n * x - sums.astype(np.int64)
            else:
                off = n * x.astype(object) - sums
            w = (x - mean) @ axes.T
            k = w.shape[1]
            yield pa.record_batch([
                batch.column(0), pa.array((off * off).sum(1).tolist(), pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(w.ravel()))],
                names=["vec_id", "deviation", "w"])
    return run


def whiten(x: DataFrame, fit: Whitening) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row and component."""
    id_type = x.schema["vec_id"].dataType.simpleString()
    rows = x.select("vec_id", "x").mapInArrow(_whitened(fit), f"vec_id {id_type}, deviation long, w array<double>")
    rows = rows.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    shares = F.lit([float(e / fit.trace) for e in fit.eigenvalues])
    return rows.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation",
                       "whitened", F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(fit.identity_error).alias("identity_error"))


def whiten_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32) -> DataFrame:
    x = quantised(vectors, id_col, vector_col)
    fit = fit_whitening(x, components)
    if fit is None:
        id_type = x.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
                                                        "explained double, identity_error double")
    return whiten(x, fit)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_vectors(table(spark, sf_dir, "embeddings"))
