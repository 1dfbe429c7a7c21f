"""Embedding whitening from an exact integer scatter.

Vectors become whole numbers; each distinct one counts once. Tasks subtract a shift and sum vectors and cross-products without rounding, as
large as these get; their sums leave as 32-bit limbs that Spark adds up. From them n XᵀX - SSᵀ is formed in whole numbers,
and only that is turned into floating point and decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.llm.common import bound_batches, release_memory
from clonespark.llm.search import _numbers, quantised
from clonespark.scratch import Scratch

#: Components of the result, at most.
COMPONENTS = 4
#: Bits of a limb: sums of 2^31 tasks' limbs fit in a long.
LIMB = 32
#: Vectors that are multiplied together.
ROWS = 4_096
#: Whole numbers up to these are exact in a float and in a long.
IN_FLOAT, IN_LONG = 1 << 53, 1 << 62


def _most(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


def shifted(rows: np.ndarray, shift: list[int]) -> np.ndarray:
    """Rows less the shift, exactly."""
    at = np.array(shift, object)
    if _most(rows) + max(map(abs, shift), default=0) < IN_LONG:
        return rows - at.astype(np.int64)
    return rows.astype(object) - at


def cross_products(y: np.ndarray) -> np.ndarray:
    """yᵀy as Python's whole numbers, in the narrowest type in which every sum is exact."""
    bound = max(len(y), 1) * _most(y) ** 2
    if bound < IN_FLOAT:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    kind = np.int64 if bound < IN_LONG else object
    y = y.astype(kind)
    return (y.T @ y).astype(object)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of a whole number; all limbs have its sign."""
    sign, left, place = (-1 if value < 0 else 1), abs(value), 0
    while left:
        if low := left & ((1 << LIMB) - 1):
            yield place, sign * low
        left, place = left >> LIMB, place + 1


def _sums(shift: list[int]):
    """A task's count, sums and cross-products as limbs: cell (-1, -1) is the count, (-1, j) a sum, (i, j) a product with i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, n = len(shift), 0
        sums, products = np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = shifted(_numbers(batch.column(0).slice(at, ROWS)), shift)
                n += len(y)
                sums += y.astype(object).sum(0) if _most(y) >= IN_LONG // ROWS else y.astype(np.int64).sum(0).astype(object)
                products += cross_products(y)
            release_memory()
        cells = [((-1, -1), n), *(((-1, j), s) for j, s in enumerate(sums)), *(((i, j), products[i, j]) for i in range(dims) for j in range(i, dims))]
        found = [(i, j, place, limb) for (i, j), v in cells for place, limb in limbs(int(v))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["i", "j", "place", "limb"])

    return run


def scatter(fit: DataFrame, shift: list[int]) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, sums of what they have over the shift, and n·YᵀY - SSᵀ: all exact. The driver gets the cells of one matrix."""
    dims = len(shift)
    cells: dict[tuple[int, int], int] = {}
    for r in fit.mapInArrow(_sums(shift), "i int, j int, place int, limb bigint").groupBy("i", "j", "place").agg(F.sum("limb").alias("limb")).collect():
        cells[r["i"], r["j"]] = cells.get((r["i"], r["j"]), 0) + (r["limb"] << (LIMB * r["place"]))
    n, sums = cells.get((-1, -1), 0), [cells.get((-1, j), 0) for j in range(dims)]
    return n, sums, [[n * cells.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]


def decomposed(n: int, exact: list[list[int]], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors (columns), eigenvalues and shares of the trace of the first components, by falling eigenvalue.

    One whose eigenvalue a double can't tell from zero gets zero for both.
    """
    dims = len(exact)
    covariance = np.array([[x / (n * n) for x in row] for row in exact]).reshape(dims, dims)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    values, trace = values[order], sum(exact[i][i] for i in range(dims)) / (n * n)
    values = np.where(values > trace * dims * np.finfo(float).eps, values, 0.0)
    return vectors[:, order], values, values / trace if trace else np.zeros(len(values))


def _projected(rows: np.ndarray, shift: list[int], n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n times each row less all rows' sums, exactly; and that on the components, scaled to variance one (NaN where there is none)."""
    y = shifted(rows, shift)
    kind = np.int64 if n * _most(y) + max(map(abs, sums), default=0) < IN_LONG else object
    z = n * y.astype(kind) - np.array(sums, object).astype(kind)
    with np.errstate(divide="ignore", invalid="ignore"):
        return z, np.where(values > 0, (z.astype(np.float64) @ vectors) / (n * np.sqrt(values)), np.nan)


def _spread(*fitted):
    """Of a task's whitened vectors: how many, their mean, and products of what they have over it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                _, w = _projected(_numbers(batch.column(0).slice(at, ROWS)), *fitted)
                mean = w.mean(0)
                yield pa.RecordBatch.from_arrays([pa.array([len(w)]), pa.array([mean.tolist()]), pa.array([((w - mean).T @ (w - mean)).ravel().tolist()])], names=["n", "mean", "products"])
            release_memory()

    return run


def identity_error(fit: DataFrame, live: int, *fitted) -> float:
    """How far the covariance of the whitened vectors is from the identity, measured on what they became. Without components 0."""
    if not live:
        return 0.0
    parts = fit.mapInArrow(_spread(*fitted), "n bigint, mean array<double>, products array<double>")
    k = len(fitted[-1])
    each = lambda c, size: F.array(*(F.sum(c(i)) for i in range(size)))
    total = parts.agg(F.sum("n").alias("n"), each(lambda i: F.col("n") * F.col("mean")[i], k).alias("m")).first()
    mean = [x / total["n"] for x in total["m"]]
    # parts' own products, and what their means have over the mean of all
    beside = lambda i: F.col("products")[i] + F.col("n") * (F.col("mean")[i // k] - F.lit(mean[i // k])) * (F.col("mean")[i % k] - F.lit(mean[i % k]))
    products = parts.agg(each(beside, k * k).alias("p")).first()["p"]
    covariance = (np.array(products, float) / total["n"]).reshape(k, k)[:live, :live]
    return float(np.abs(covariance - np.eye(live)).max())


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, components: int = COMPONENTS) -> DataFrame:
    """Each vector on the first principal components of the distinct vectors, scaled to variance one.

    Components x become floor(scale * x). Returns for each row whose vector is neither null nor holds null or non-finite components, and each of the
    first components (fewer, if vectors are shorter): id_col, component (from 1), n (distinct vectors), deviation (the squared length of n x - S, exact; null
    if it is out of a long's range), whitened, explained (the component's share of the variance) and identity_error (the same everywhere). A component
    of no variance has null for whitened and 0 for explained. A shorter vector counts as padded with zeros. Rows with null or repeated
    ids are whitened each, repeated vectors weigh once; other columns are ignored; a table without usable vectors gives an empty result.
    Components out of a long's range saturate. The driver gets the cells of a matrix of the vectors' dimension.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    bound_batches(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    clean = vectors.select(F.col(id_col).alias("id"), quantised(vector_col, scale).alias("x")).filter("x IS NOT NULL")
    dims = clean.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], schema)
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("x")))
    clean = clean.select("id", F.when(F.size("x") < dims, padded).otherwise(F.col("x")).alias("x"))
    fit = scratch.save(clean.select("x").distinct())
    shift = list(fit.first()["x"])  # any one will do: the scatter is the same
    n, sums, exact = scatter(fit, shift)
    basis, values, shares = decomposed(n, exact, components)
    fitted = (shift, n, sums, basis, values)
    error = identity_error(fit, int((values > 0).sum()), *fitted)
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                z, w = _projected(_numbers(part.column(1)), *fitted)
                if dims * _most(z) ** 2 >= IN_LONG:
                    z = z.astype(object)
                squares = pa.array([d if d < 1 << 63 else None for d in (z * z).sum(1).tolist()], pa.int64())
                row, m = np.repeat(np.arange(len(w)), k), len(w)
                columns = [
                    part.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), squares.take(pa.array(row)),
                    pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])
            release_memory()

    return clean.mapInArrow(run, schema)
