"""Whitened principal components of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers ``floor(1024 c) + 100000``, so counts, sums and deviations
are exact. The components are right singular vectors of the centred rows ``X``. Each
step of the bidiagonalisation is one pass in which every task multiplies its rows,
``u = X w``, and their transposes, ``X'u``, and Spark adds the results: two products in
turn, and nothing longer than a vector of one value per dimension leaves the tasks.
The left vectors, as long as the table, are never gathered: ``u_k = X w_k`` for a short
``w_k``, so their inner products are those of ``w_j`` and ``X'u``. Both sides are
orthogonalised against all earlier vectors. The singular values and vectors of the
small bidiagonal matrix give deviations and components.

A step that finds nothing new goes on from a new direction. It ends when the leading
triplets have no residual left and all variance outside the visited space together is
less than the last of them, so that no equal value is overlooked, or after one step
per dimension.

Edge cases: rows whose vector is null or holds null or non-finite entries are dropped,
as are vectors that are not of the most frequent length (the longest of several);
``1024 c`` is held within 2^52; rows without vec_id are returned with null; repeated
rows count each; directions without variance are no components, so an empty table, a
single row or equal rows give an empty table; a deviation beyond a long is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm.batches import small_batches
from spendcast.llm.store import Store, brief_shuffles

COMPONENTS = 8
BLOCK_BYTES = 2 << 20
RESIDUAL = 1e-14  # of the largest singular value
NO_VARIANCE = 1e-13  # of the largest variance


@dataclass
class Whitening:
    """``components`` has one column per component, ``variances`` their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(self.n, 1)

    @property
    def scaled(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is complete."""
    vectors = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("c"))
    sound = "c IS NOT NULL AND forall(c, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    limit = f"{float(1 << 52)!r}D"
    x = f"transform(c, x -> floor(greatest(least(1024D * x, {limit}), -{limit})) + 100000)"
    vectors = vectors.filter(sound).withColumn("x", F.expr(x)).drop("c")
    usual = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return vectors.filter(F.size("x") == (usual["size"] if usual else 0))


def blocks(vectors: DataFrame) -> DataFrame:
    """``ids, n, x``: vectors side by side as 64-bit integers, a few megabytes a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            size = len(flat) // max(batch.num_rows, 1)
            step = max(1, BLOCK_BYTES // (8 * max(size, 1)))
            for a in range(0, batch.num_rows, step):
                part = ids.slice(a, step)
                offsets = pa.array([0, len(part)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(offsets, part), pa.array([len(part)], pa.int64()), pa.array([flat[a * size : (a + len(part)) * size].tobytes()], pa.binary())],
                    ["ids", "n", "x"],
                )

    return vectors.mapInArrow(run, "ids array<long>, n long, x binary")


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of each block of ``n, x``."""
    for n, x in zip(batch.column("n").to_pylist(), batch.column("x")):
        yield np.frombuffer(x.as_buffer(), np.int64).reshape(n, -1)


def added(stored: DataFrame, sums_of, size: int, kind: str = "double") -> np.ndarray:
    """Sums over all blocks of ``sums_of(matrix)``, a vector of ``size`` values.

    A task adds its blocks, Spark adds the tasks; the driver gets ``size`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _matrices(batch):
                own = sums_of(x)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    parts = stored.select("n", "x").mapInArrow(run, f"place long, value {kind}")
    out = np.zeros(size, np.int64 if kind == "long" else float)
    with brief_shuffles(stored.sparkSession):
        for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
            out[r["place"]] = r["value"]
    return out


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(product, size: int, scale: float, wanted: int, energy: float) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors (columns) and singular values of the rows behind
    ``product(w)``, which returns ``X'Xw`` and ``|Xw|^2``.

    ``scale`` bounds the largest singular value, ``energy`` is the sum of all squares."""
    rng = np.random.default_rng(13)
    right, short, images = np.zeros((size, size)), np.zeros((size, size)), np.zeros((size, size))
    alpha, beta = np.zeros(size), np.zeros(size)
    least = scale * 1e-13
    v = rng.standard_normal(size)
    v /= np.linalg.norm(v)
    for k in range(size):
        right[:, k] = v
        w = v - beta[k - 1] * short[:, k - 1] if k else v
        image, square = product(w)
        shared = short[:, :k].T @ image  # inner products with the earlier left vectors
        w, image = w - short[:, :k] @ shared, image - images[:, :k] @ shared
        alpha[k] = math.sqrt(max(square - shared @ shared, 0.0))
        if alpha[k] > least:
            short[:, k], images[:, k] = w / alpha[k], image / alpha[k]
        else:
            alpha[k] = 0.0
        v = _orthogonal(images[:, k] - alpha[k] * v, right[:, : k + 1])
        beta[k] = np.linalg.norm(v)
        done = k + 1
        matrix = np.diag(alpha[:done]) + np.diag(beta[: done - 1], 1)
        left, values, turned = np.linalg.svd(matrix)
        top = min(wanted, done)
        residual = beta[k] * np.abs(left[-1, :top]).max()
        outside = energy - (matrix**2).sum()
        if done >= wanted and residual <= RESIDUAL * values[0] and outside < values[top - 1] ** 2:
            break
        if beta[k] <= least:
            beta[k] = 0.0
            v = _orthogonal(rng.standard_normal(size), right[:, :done])
        v /= max(np.linalg.norm(v), np.finfo(float).tiny)
    vectors = right[:, :done] @ turned.T[:, :wanted]
    return vectors, values[:wanted]


def fit(stored: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of all stored blocks."""
    head = stored.select("n", F.expr("length(x) div (8 * n)").alias("size")).first()
    n = stored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = head["size"] if head else 0
    sums = added(stored, lambda x: x.sum(0), size, "long")
    out = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0)
    mean = out.mean

    def energies(x):
        centred = x - mean
        return (centred * centred).sum(0)

    energy = float(added(stored, energies, size).sum())
    if energy <= 0:
        return out

    def product(w: np.ndarray) -> tuple[np.ndarray, float]:
        def both(x):
            centred = x - mean
            u = centred @ w
            return np.append(centred.T @ u, u @ u)

        found = added(stored, both, size + 1)
        return found[:-1], float(found[-1])

    vectors, values = bidiagonalise(product, size, math.sqrt(energy), min(components, size), energy)
    variances = values**2 / n
    some = variances > NO_VARIANCE * variances[0]
    return Whitening(n, sums, vectors[:, some], variances[some], energy / n)


def identity_error(stored: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k, mean, scaled = len(model.variances), model.mean, model.scaled

    def moments(x):
        y = (x - mean) @ scaled
        return np.concatenate([(y.T @ y).ravel(), y.sum(0)])

    found = added(stored, moments, k * k + k) / model.n
    middle = found[k * k :]
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(middle, middle) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sums of squares of ``n x - S``, null beyond a long."""
    apart = n * x - sums
    near = (apart.astype(float) ** 2).sum(1)
    return pa.array((apart * apart).sum(1), mask=near >= 2.0**63)


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = rows.sparkSession
    small_batches(spark)
    stored = Store(spark).put(blocks(whole_vectors(rows)), "vector-blocks")
    model = fit(stored, components)
    k, mean, scaled, n, sums = len(model.variances), model.mean, model.scaled, model.n, model.sums
    error = identity_error(stored, model) if k else 0.0
    explained = model.variances / model.trace if k else model.variances
    names = ["vec_id", "component", "deviation", "whitened", "explained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _matrices(batch)):
                every = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(every), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), deviations(x, n, sums).take(every),
                     pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(explained, len(x)))],
                    names,
                )

    found = stored.mapInArrow(run, "vec_id long, component int, deviation long, whitened double, explained double")
    return found.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )


def whitening_query(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))
