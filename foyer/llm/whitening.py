"""Whitening of embeddings by the exact principal components of their whole-number scatter.

Entries become whole numbers, so sums and products are exact: each task adds up its rows' products and
gives them in limbs that add up without loss. The driver holds sums per pair of dimensions, never rows.
The scatter's characteristic polynomial is made modulo many primes, one task for some of the primes, the largest
roots are parted exactly, and a task per root finds its vectors. Their size depends on the
dimensions alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from foyer.llm import charpoly
from foyer.llm.common import fresh, named

SCALE, OFFSET, MOST = 64, 1_000_000, 32
#: Entries beyond this do not become a long.
_LARGEST = 2.0**62 / SCALE
_LIMB = 40
#: Rows multiplied in one go.
_CHUNK = 4096


@dataclass(frozen=True)
class Whitening:
    """``roots`` of n^2 times the covariance; ``vectors`` a unit vector a row; ``sums`` of the whole numbers."""

    n: int
    sums: tuple[int, ...]
    roots: tuple[Fraction, ...]
    vectors: tuple[tuple[float, ...], ...]
    explained: tuple[float, ...]


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector takes part: not null or empty, and all entries numbers below 2^56.

    Of several lengths only the most common one (the longest of equals) takes part.
    """
    entries = named(vector).cast("array<double>")
    good = rows.where((F.size(entries) > 0) & F.forall(entries, lambda c: F.abs(c) < _LARGEST))
    lengths = good.groupBy(F.size(named(vector)).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).head()
    return good.where(F.size(named(vector)) == (most["length"] if most else 0))


def _whole(column: pa.Array) -> np.ndarray:
    """The rows' entries times the scale, rounded down, as longs without the offset."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), -1)


def _products(y: np.ndarray) -> np.ndarray:
    """The exact matrix of sums of products, as Python's whole numbers."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for first in range(0, len(y), _CHUNK):
        part = y[first : first + _CHUNK]
        largest = int(np.abs(part).max(initial=0))
        if largest * largest * len(part) < 1 << 53:
            floats = part.astype(np.float64)
            total += (floats.T @ floats).astype(np.int64).astype(object)
        else:
            exact = part.astype(object)
            total += exact.T @ exact
    return total


def _scatter(rows: DataFrame, vector: str, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums of the entries, and n^2 times the covariance; all exact."""
    upper = np.triu_indices(d)

    def add(batches):
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                y = _whole(batch.column(0))
                n += len(y)
                sums += y.astype(object).sum(0) if np.abs(y).max() > 1 << 40 else y.sum(0).astype(object)
                products += _products(y)
        if n:
            cells, limbs, values = [], [], []
            for cell, value in enumerate([n, *sums, *products[upper]]):
                limb, sign, rest = 0, (1 if value >= 0 else -1), abs(int(value))
                while rest:
                    cells.append(cell)
                    limbs.append(limb)
                    values.append(sign * (rest & ((1 << _LIMB) - 1)))
                    rest, limb = rest >> _LIMB, limb + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int64()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())],
                ["cell", "limb", "value"],
            )

    parts = rows.select(named(vector).cast("array<double>").alias("y")).mapInArrow(add, "cell long, limb int, value long")
    found = [0] * (1 + d + len(upper[0]))
    for cell, limb, value in parts.groupBy("cell", "limb").agg(F.sum("value").alias("value")).collect():
        found[cell] += value << (_LIMB * limb)
    n, sums = found[0], found[1 : d + 1]
    scatter = [[0] * d for _ in range(d)]
    for i, j, value in zip(*upper, found[d + 1 :], strict=True):
        scatter[i][j] = scatter[j][i] = n * value - sums[i] * sums[j]
    return n, [s + n * OFFSET for s in sums], scatter


def _polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial; each task takes some primes."""
    primes = charpoly.primes_for(matrix)

    def reduce(batches):
        for batch in batches:
            found = [charpoly.polynomial_modulo(matrix, p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "found"])

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    frame = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    rows = frame.mapInArrow(reduce, "p long, found array<long>").collect()
    return charpoly.from_remainders([row.p for row in rows], [row.found for row in rows])


def _vectors(spark, matrix: list[list[int]], bits: int, roots: list[tuple[int, int]]) -> list[list[float]]:
    """Unit vectors by falling root; a task a root."""
    def solve(batches):
        for batch in batches:
            for at, root, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = list(charpoly.eigenvectors(matrix, bits, int(root), times))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()),
                     pa.array(found, pa.list_(pa.float64()))],
                    ["at", "which", "vector"],
                )

    listed = [(at, str(root), times) for at, (root, times) in enumerate(roots)]
    frame = spark.createDataFrame(listed, "at int, root string, times int").repartition(len(roots))
    rows = frame.mapInArrow(solve, "at int, which int, vector array<double>").collect()
    return [row.vector for row in sorted(rows, key=lambda row: (row["at"], row.which))]


def fit(rows: DataFrame, vector: str = "embedding", most: int = MOST) -> Whitening:
    """The exact sums and up to ``most`` components of the usable rows (see ``usable``).

    An entry c counts as the whole number floor(64 c) + 1,000,000. Components of no variance are
    none: rows that are all equal have no component, and no rows at all have neither sums.
    Of components with equal variance any orthogonal ones may come.
    """
    spark = rows.sparkSession
    first = rows.select(F.size(named(vector)).alias("d")).head()
    if first is None:
        return Whitening(0, (), (), (), ())
    n, sums, scatter = _scatter(rows, vector, first.d)
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    if trace == 0:
        return Whitening(n, tuple(sums), (), (), ())
    coefficients = _polynomial(spark, scatter)
    guesses = np.linalg.eigvalsh(np.array([[v / trace for v in row] for row in scatter])) * float(trace)
    bits, roots = charpoly.top_roots(coefficients, most, guesses.tolist())
    values = [Fraction(root, 1 << bits) for root, times in roots for _ in range(times)][:most]
    vectors = _vectors(spark, scatter, bits, roots)[:most]
    return Whitening(
        n, tuple(sums), tuple(values), tuple(map(tuple, vectors)), tuple(float(v / trace) for v in values)
    )


def _projected(y: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int]]:
    """The whitened rows, and each row's sum of (n x - S)^2."""
    small = [s - model.n * OFFSET for s in model.sums]
    d = y.shape[1]
    reach = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, small))
    if reach < 1 << 62:
        off = y * model.n - np.array(small, np.int64)
    else:
        off = y.astype(object) * model.n - np.array(small, object)
    if reach * reach * d < 1 << 62:
        deviation = (off * off).sum(1).tolist()
    else:
        exact = off.astype(object)
        deviation = (exact * exact).sum(1).tolist()
    ways = np.array(model.vectors).reshape(-1, d) / np.sqrt([float(r) for r in model.roots]).reshape(-1, 1)
    return off.astype(np.float64) @ ways.T, deviation


def whitened(rows: DataFrame, model: Whitening, vector: str = "embedding", keep: Sequence[str] = ()) -> DataFrame:
    """The usable rows' kept columns with ``deviation`` and ``whitened``, named otherwise where kept columns are so.

    ``deviation`` is the sum of (n x - S)^2 over the dimensions, exact, as decimal text; ``whitened`` has (x - S / n) along each component, over the root of its variance.
    """
    kept = rows.select(*map(named, keep))
    names = [fresh(name, kept) for name in ("deviation", "whitened")]

    def work(batches):
        for batch in batches:
            y = _whole(batch.column(batch.num_columns - 1))
            found, deviation = _projected(y, model) if len(y) else (np.zeros((0, 0)), [])
            flat = pa.array(found.ravel())
            starts = np.arange(len(y) + 1, dtype=np.int32) * len(model.roots)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(map(str, deviation), pa.string()), pa.ListArray.from_arrays(pa.array(starts), flat)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *names])

    schema = kept.schema.add(names[0], StringType()).add(names[1], ArrayType(DoubleType()))
    last = fresh("whole", kept)
    return rows.select(*map(named, keep), named(vector).cast("array<double>").alias(last)).mapInArrow(work, schema)


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity; null without components."""
    m = len(model.roots)
    if not m:
        return None
    cells = m * m + m

    def add(batches):
        total = np.zeros(cells)
        for batch in batches:
            if batch.num_rows:
                w, _ = _projected(_whole(batch.column(0)), model)
                total += np.concatenate([(w.T @ w).ravel(), w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], ["cell", "value"])

    entries = rows.select(named(vector).cast("array<double>").alias("y"))
    sums = entries.mapInArrow(add, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = np.zeros(cells)
    for cell, value in sums.collect():
        found[cell] = value / model.n
    means = found[m * m :]
    covariance = found[: m * m].reshape(m, m) - np.outer(means, means)
    return float(np.abs(covariance - np.eye(m)).max())
