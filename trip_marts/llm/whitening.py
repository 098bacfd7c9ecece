"""Whitening of vectors by the exact characteristic polynomial of their scatter.

Entries become integers, so that the scatter matrix n * sum(x x') - S S' is exact. Its
polynomial is found modulo many primes by Hessenberg reduction, primes spread over
Spark's tasks, and put together by Chinese remaindering. Its largest roots are isolated
by exact root counts and refined to a 2**-64 of the scatter's unit, and inverse iteration in the
null space of each gives the components.

Rows pass through Spark twice: once for the sums of products, of which every task gives a
matrix of the vectors' dimension, and once for the projections.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.llm import charpoly
from trip_marts.llm.shared import saved

SCALE = 1024
SHIFT = 100_000
#: Fraction bits of the roots, in units of the integer scatter.
ROOT_BITS = 64
#: Bits of a part of a sum of products, so that Spark adds up parts without overflow.
PART_BITS = 30
#: Rows multiplied at once: a sum of so many products of limbs is exact in a double.
ROWS_AT_ONCE = 1 << 16
LIMB_BITS = 18
#: Primes that one task reduces side by side.
PRIMES_A_TASK = 16
_LONG = 1 << 63


@dataclass(frozen=True)
class Whitener:
    """Sums of the fit list and the components of its covariance, largest first."""

    n: int
    sums: np.ndarray  # of x by dimension, whole numbers
    components: np.ndarray  # unit vectors, one a row
    eigenvalues: np.ndarray  # of the covariance of x
    explained: np.ndarray

    @property
    def dimension(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame) -> DataFrame:
    """`(vec_id, x)` of the rows to fit; x - SHIFT is what is stored.

    Vectors that are null, empty or hold null or non-finite entries are dropped, as are entries
    too large for a long. Vectors must have one dimension; of several, the most frequent is
    kept (of equally frequent ones the largest), others are dropped.
    """
    entry: Column = F.col("embedding")
    good = F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float(1 << 52)))
    )
    whole = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    kept = vectors.where(entry.isNotNull() & (F.size(entry) > 0) & good)
    return kept.select("vec_id", whole.alias("x"), F.size(entry).alias("d"))


def common_dimension(rows: DataFrame) -> int:
    """The most frequent length of the vectors, 0 for an empty table."""
    best = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x of 64-bit integers as whole numbers, by products of limbs that doubles hold exactly."""
    limbs, rest = [], x.astype(np.int64)
    while True:
        low = rest & ((1 << LIMB_BITS) - 1)
        low -= (low >> (LIMB_BITS - 1)) << LIMB_BITS  # signed limbs are small for small numbers of either sign
        limbs.append(low.astype(float))
        rest = (rest - low) >> LIMB_BITS
        if not rest.any():
            break
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            exact = (a.T @ b).astype(np.int64).astype(object)
            total = total + (exact << (LIMB_BITS * (i + j)))
    return total


def summed_products(rows: DataFrame, d: int) -> np.ndarray:
    """(x, 1)'(x, 1) over all rows, exactly: products, sums and the number of rows.

    Every task adds up its own rows; Spark adds up the tasks' sums in parts of
    `PART_BITS` bits. What reaches the driver depends on the dimension only.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                x = _matrix(batch.column(0).slice(at, ROWS_AT_ONCE), d)
                total = total + exact_products(np.column_stack([x, np.ones(len(x), np.int64)]))
        places, parts, values = [], [], []
        for place, value in enumerate(total[np.triu_indices(d + 1)].tolist()):
            part = 0
            while value not in (0, -1) or part == 0:
                places.append(place)
                parts.append(part)
                values.append(value & ((1 << PART_BITS) - 1))
                value, part = value >> PART_BITS, part + 1
            places.append(place)
            parts.append(part)
            values.append(value)  # the sign
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (places, parts, values)], names=["place", "part", "value"])

    made = rows.select("x").mapInArrow(each, "place long, part long, value long")
    found = made.groupBy("place", "part").agg(F.sum("value").alias("value")).collect()
    flat = [0] * ((d + 1) * (d + 2) // 2)
    for place, part, value in found:
        flat[place] += value << (PART_BITS * part)
    out = np.zeros((d + 1, d + 1), object)
    out[np.triu_indices(d + 1)] = flat
    return out + out.T - np.diag(np.diag(out))


def characteristic_polynomial(rows: DataFrame, matrix: list[list[int]]) -> list[int]:
    """det(x I - A) of a symmetric integer matrix, lowest coefficient first.

    The reductions modulo primes are one Spark job; residues of the polynomial are put together here.
    """
    spark, d = rows.sparkSession, len(matrix)
    primes = charpoly.primes_below(charpoly.LARGEST_PRIME, charpoly.coefficient_bound(matrix))
    held = spark.sparkContext.broadcast(matrix)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PRIMES_A_TASK):
                own = batch.column(0).slice(at, PRIMES_A_TASK)
                p = own.to_numpy().astype(np.int64)
                whole = np.array(held.value, object)
                residues = np.array([(whole % int(q)).astype(np.int64) for q in p])
                found = charpoly.polynomials_mod(residues, p)
                yield pa.record_batch([own, pa.array(list(found), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = -(-len(primes) // PRIMES_A_TASK)
    listed = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    found = {r.prime: r.residues for r in listed.mapInArrow(each, "prime long, residues array<long>").collect()}
    held.destroy()
    return charpoly.combined(np.array([found[p] for p in primes], np.int64).reshape(len(primes), d + 1), primes)


def fit(rows: DataFrame, d: int, count: int = 8) -> Whitener:
    """Components of the covariance of all rows, `count` at most.

    Components with an eigenvalue of zero are left out, so that there are fewer where
    the vectors span fewer dimensions. Of an eigenvalue that occurs several times, any
    orthonormal components.
    """
    products = summed_products(rows, d)
    n, sums = int(products[d, d]), products[:d, d]
    scatter = (n * products[:d, :d] - np.outer(sums, sums)).tolist()  # n * n times the covariance
    trace = sum(scatter[i][i] for i in range(d))
    vectors, values = [], []
    if trace:
        poly = characteristic_polynomial(rows, scatter)
        roots = charpoly.largest_roots(poly, count, ROOT_BITS)
        for root, times in [r for r in roots if r[0]]:
            vectors += [_signed(v) for v in charpoly.null_space(scatter, root, times, ROOT_BITS)]
            values += [root] * times
    unit = n * n << ROOT_BITS
    return Whitener(
        n,
        np.array([int(s) + n * SHIFT for s in sums], object),
        np.array(vectors[:count], float).reshape(-1, d),
        np.array([v / unit for v in values[:count]], float),
        np.array([v / (trace << ROOT_BITS) for v in values[:count]], float),
    )


def _signed(v: np.ndarray) -> np.ndarray:
    """Of the two signs that with a positive largest entry."""
    return v if v[np.abs(v).argmax()] > 0 else -v


def projected(rows: DataFrame, model: Whitener) -> DataFrame:
    """`(vec_id, deviation, whitened)` of every row; whitened has one entry a component.

    `deviation` is null where it does not fit into a long.
    """
    held = rows.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        n, d = model.n, model.dimension
        sums = model.sums - n * SHIFT  # of what is stored
        for batch in batches:
            x = _matrix(batch.column(1), d)
            most = n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in sums)
            kind = np.int64 if most * most * d < _LONG else object
            away = n * x.astype(kind) - sums.astype(kind)
            squares = (away * away).sum(axis=1)
            spread = np.sqrt(model.eigenvalues)
            white = (away.astype(float) / n) @ model.components.T / spread
            deviation = pa.array([int(s) if s < _LONG else None for s in squares], pa.int64())
            yield pa.record_batch(
                [batch.column(0).cast(pa.int64()), deviation, pa.array(list(white), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.select("vec_id", "x").mapInArrow(each, "vec_id long, deviation long, whitened array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, 0 without components."""
    if k == 0:
        return 0.0
    at = [F.col("whitened")[i] for i in range(k)]
    means = white.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)]).first()
    centred = [c - F.lit(m) for c, m in zip(at, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def whiten(vectors: DataFrame, count: int = 8) -> DataFrame:
    """Whitened coordinates of every usable row, one row for each component.

    Columns: `vec_id`, `component` from 1, `n` (vectors fitted), `deviation` (squared distance
    of n * x from the sums), `whitened`, `explained` (the component's share of the variance),
    `identity_error`. Rows are dropped as in `usable`; repeated rows and ids count as often
    as they occur, and a null id stays null. Other columns are ignored. There are no rows for
    an empty table, nor where all vectors are equal, as then no component has a variance.
    """
    rows = usable(vectors.select("vec_id", "embedding"))
    d = common_dimension(rows)
    rows = saved(rows.where(F.col("d") == d).drop("d"), "vectors")
    empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if d == 0:
        return vectors.sparkSession.createDataFrame([], empty)
    model = fit(rows, d, count)
    white = saved(projected(rows, model), "whitened")
    error = identity_error(white, len(model.eigenvalues))
    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return white.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
