"""Whitening of embeddings: uncorrelated components of variance one, from exact integer statistics.

An entry c of a vector becomes the whole number x = floor(64 * c) + 1000000.  Each distinct
vector of such numbers counts once; their sums and products are added up exactly, by the
task and then by Spark, so the n^2-fold covariance is a matrix of whole numbers.  Its
characteristic polynomial is exact too (``charpoly``): each task reduces the matrix modulo
some primes.  Each component's eigenvalue and vector are then found in a task of its own.
What reaches the driver is of the size of that matrix, whatever the number of vectors.

Rows whose vector is NULL, or holds a NULL, NaN or infinite entry, are dropped; all others
stay, repeated rows and ids as often as they come.  Vectors of different length are fitted
apart, each length by its own.  Components of no variance don't exist, so there may be
fewer than asked for: none for a single distinct vector.  Equal eigenvalues get any
vectors at right angles in their common space, the same in each run.  An x beyond a long
counts as the nearest long; a deviation that its type can't hold is NULL.  An empty table gives an empty result; other columns pass
through, and a new column whose name is taken gets underscores before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableward.llm import charpoly
from tableward.llm.common import free_name
from tableward.session import stage

#: Whole numbers per unit, the number for zero, and the largest number of components.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Entries multiplied at a time; bits of the lower part in which sums travel.
CELLS, PART = 1 << 20, 40
_EXACT, _MOST = 1 << 53, 10**38


def steps(vector: Column) -> Column:
    """The whole numbers of a vector, less ``OFFSET``, which no covariance depends on."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    entries = vector.cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf)))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector in a list column the rows' places and the rows, some at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for size in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == size)
        step = max(CELLS // max(size, 1), 1)
        for at in range(0, len(places), step):
            some = places[at : at + step]
            yield some, values[offsets[some][:, None] + np.arange(size)]


def products(rows: np.ndarray) -> np.ndarray:
    """The exact sums of products of each two columns, as Python numbers."""
    most = max(-int(rows.min(initial=0)), int(rows.max(initial=0)))
    if most * most * len(rows) < _EXACT:  # floating point is exact as long as all sums are whole and below 2^53
        exact = rows.astype(np.float64)
        return (exact.T @ exact).astype(np.int64).astype(object)
    exact = rows.astype(object)
    return exact.T @ exact


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts, sums and products: place -1 stands for the constant one."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, rows in _matrices(batch.column(0)):
            size = rows.shape[1]
            with_one = np.hstack([np.ones((len(rows), 1), np.int64), rows])
            held[size] = held.get(size, 0) + products(with_one)
    for size, sums in held.items():
        i, j = np.triu_indices(size + 1)
        values = sums[i, j]
        high = pa.array([Decimal(int(v) >> PART) for v in values], pa.decimal128(38, 0))
        low = pa.array([int(v) & ((1 << PART) - 1) for v in values], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(i), size, np.int32)), pa.array((i - 1).astype(np.int32)), pa.array((j - 1).astype(np.int32)), high, low],
            names=["size", "i", "j", "high", "low"],
        )


@dataclass(frozen=True)
class Whitening:
    """The components of the vectors of one length."""

    n: int  # distinct vectors
    sums: tuple[int, ...]  # of their numbers, less OFFSET
    vectors: np.ndarray  # a component a row
    roots: np.ndarray  # n^2 times the eigenvalues
    explained: tuple[float, ...]
    identity_error: float = 0.0

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """n times each row less the sums: n times its distance from the mean, exact."""
        sums = np.array(self.sums, object)
        most = max([abs(s) for s in self.sums] + [self.n * max(-int(rows.min(initial=0)), int(rows.max(initial=0)))], default=0)
        return self.n * rows - sums.astype(np.int64) if most < 1 << 61 else self.n * rows.astype(object) - sums

    def whitened(self, distances: np.ndarray) -> np.ndarray:
        return distances.astype(np.float64) @ self.vectors.T / np.sqrt(self.roots)


def deviations(distances: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    most = max(-int(distances.min(initial=0)), int(distances.max(initial=0)))
    if most * most * max(distances.shape[1], 1) < 1 << 63:
        return (distances * distances).sum(axis=1).tolist()
    return [int(sum(v * v for v in row)) for row in distances.tolist()]


def _characteristic(spark: SparkSession, matrix: list[list[int]]) -> charpoly.Roots:
    """The roots of the matrix's polynomial, which tasks reduce modulo one prime after the other."""
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    chosen = charpoly.primes(charpoly.needed(trace, len(matrix)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [charpoly.polynomial_mod(matrix, p) for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "residues": found})

    parts = min(len(chosen), spark.sparkContext.defaultParallelism)
    dealt = spark.range(0, len(chosen), 1, parts).select(F.element_at(F.array(*map(F.lit, chosen)), (F.col("id") + 1).cast("int")).cast("long").alias("p"))
    got = dealt.mapInPandas(run, "p long, residues array<long>").collect()
    return charpoly.Roots(charpoly.combined((r.p, r.residues) for r in sorted(got, key=lambda r: r.p)))


def _components(spark: SparkSession, matrix: list[list[int]], most: int) -> tuple[list[float], list[list[float]]]:
    """The roots and unit vectors of the first components, a task each."""
    roots = _characteristic(spark, matrix)
    count = min(most, roots.positive)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rank in batch["id"].tolist():
                low, bits, before, times = roots.bracket(rank)
                root, vectors = charpoly.eigenvectors(matrix, low, bits, times)
                yield pd.DataFrame({"rank": [rank], "root": [str(root)], "vector": [vectors[rank - 1 - before].tolist()]})

    if not count:
        return [], []
    got = spark.range(1, count + 1, 1, count).mapInPandas(run, "rank long, root string, vector array<double>").collect()
    got = sorted(got, key=lambda r: r["rank"])
    return [float(r.root) for r in got], [list(r.vector) for r in got]


def _identity(models: dict[int, Whitening]):
    """Sums and products of the whitened vectors of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, rows in _matrices(batch.column(0)):
                size = rows.shape[1]
                if size in models and len(models[size].roots):
                    out = models[size].whitened(models[size].distances(rows))
                    out = np.hstack([np.ones((len(out), 1)), out])
                    held[size] = held.get(size, 0) + out.T @ out
        for size, sums in held.items():
            i, j = np.triu_indices(len(sums))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), size, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[i, j])],
                names=["size", "i", "j", "total"],
            )

    return run


def fit(vectors: DataFrame, column: str, most: int = COMPONENTS) -> dict[int, Whitening]:
    """The components of each length of vector in ``column``, arrays of whole numbers; each distinct one counts once."""
    spark = vectors.sparkSession
    listed = stage(vectors.select(F.col(column).alias("x")).where(F.size("x") > 0).distinct(), "distinct-vectors")
    summed = listed.mapInArrow(_gram, "size int, i int, j int, high decimal(38,0), low long").groupBy("size", "i", "j").agg(
        F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).alias("low")
    )
    sums = {(r["size"], r.i, r.j): (int(r.high) << PART) + int(r.low) for r in summed.collect()}
    models = {}
    for size in sorted({size for size, *_ in sums}):
        n, total = sums[size, -1, -1], [sums[size, -1, i] for i in range(size)]
        matrix = [[n * sums[size, min(i, j), max(i, j)] - total[i] * total[j] for j in range(size)] for i in range(size)]
        trace = sum(matrix[i][i] for i in range(size))
        roots, found = _components(spark, matrix, most) if trace else ([], [])
        models[size] = Whitening(n, tuple(total), np.array(found).reshape(len(found), size), np.array(roots), tuple(r / trace for r in roots))
    if not models:
        return {}
    checked = listed.mapInArrow(_identity(models), "size int, i int, j int, total double").groupBy("size", "i", "j").agg(F.sum("total").alias("total"))
    got = {(r["size"], r.i, r.j): r.total for r in checked.collect()}
    for size, model in models.items():
        k = len(model.roots)
        mean = [got[size, 0, i + 1] / model.n for i in range(k)]
        error = max((abs(got[size, i + 1, j + 1] / model.n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k)), default=0.0)
        models[size] = Whitening(model.n, model.sums, model.vectors, model.roots, model.explained, error)
    return models


def whiten(df: DataFrame, vector: str, most: int = COMPONENTS) -> DataFrame:
    """The rows of ``df`` with a usable ``vector``, with the struct ``whitening`` added.

    It holds ``n``, the number of distinct vectors; ``deviation``, the exact sum of squares of
    n * x less the sums; ``whitened`` and ``explained``, a number for each component; and
    ``identity_error``, how far the covariance of all whitened distinct vectors is from one.
    """
    x, into = free_name(df, "_x"), free_name(df, "whitening")
    rows = df.where(usable(F.col(vector))).withColumn(x, steps(F.col(vector)))
    models = fit(rows, x, most)

    @F.pandas_udf("n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")
    def score(column: pd.Series) -> pd.DataFrame:
        out = [None] * len(column)
        arrow = pa.array(column, pa.list_(pa.int64()))
        for places, found in _matrices(arrow):
            model = models.get(found.shape[1], Whitening(0, (0,) * found.shape[1], np.zeros((0, found.shape[1])), np.zeros(0), ()))
            apart = model.distances(found)
            for place, deviation, line in zip(places, deviations(apart), model.whitened(apart).tolist()):
                out[place] = (model.n, Decimal(deviation) if deviation < _MOST else None, line, list(model.explained), model.identity_error)
        return pd.DataFrame(out, columns=["n", "deviation", "whitened", "explained", "identity_error"])

    return rows.withColumn(into, score(x)).drop(x)


def components(df: DataFrame, vec_id: str, vector: str, most: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: ``vec_id, component`` and what ``whiten`` gives."""
    found = whiten(df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), "vector", most)
    one = F.posexplode(F.arrays_zip("whitening.whitened", "whitening.explained"))
    long = found.select("vec_id", "whitening.n", F.col("whitening.deviation").try_cast("long").alias("deviation"), "whitening.identity_error", one)
    return long.select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", F.col("col.whitened").alias("whitened"),
        F.col("col.explained").alias("explained"), "identity_error",
    )
