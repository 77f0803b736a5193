"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers, so sums and the scatter matrix over the distinct vectors
are exact, however tasks divide the rows. The scatter's characteristic polynomial is
found modulo many primes, one task a few primes, and recombined; its real roots are the
eigenvalues, and inverse iteration at each root, again one task each, gives the
components. The driver holds only matrices of the vector's dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.llm import exact
from tellerbook.llm.store import need_columns, stored

#: Steps of a unit; an entry c becomes floor(STEPS * c) + ORIGIN.
STEPS, ORIGIN = 64, 1_000_000
#: Entries of this size have no whole number that can be centred in 64 bits.
LARGEST = 2.0**55
#: Bits of the parts whose products are added as doubles, and the rows added at once: exact.
_BITS, _ROWS = 18, 1 << 13
#: Whitened values are rounded to this step for the check of their covariance.
_CHECK_STEP = 1 << 24


@dataclass(frozen=True)
class Moments:
    """Count, sums and sums of products of integer vectors, exact."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def scatter(self) -> list[list[int]]:
        """n squared times the covariance: whole numbers."""
        s = self.sums
        return [[self.n * x - s[i] * s[j] for j, x in enumerate(row)] for i, row in enumerate(self.products)]


@dataclass(frozen=True)
class Whitening:
    """Components by falling eigenvalue; ``roots`` are those of the scatter, over 2^GRID."""

    moments: Moments
    roots: list[int]
    vectors: list[list[float]]

    def explained(self) -> list[float]:
        """Each component's share of the trace."""
        scatter = self.moments.scatter()
        trace = sum(scatter[i][i] for i in range(len(scatter)))
        return [float(Fraction(root, trace << exact.GRID)) for root in self.roots]


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _parts(x: np.ndarray) -> list[np.ndarray]:
    """Doubles of few bits that add up to ``x``, the k-th times 2^(k * _BITS)."""
    parts = []
    while x.min() < -(1 << _BITS) or x.max() >= 1 << _BITS:
        parts.append((x & ((1 << _BITS) - 1)).astype(np.float64))
        x = x >> _BITS
    return [*parts, x.astype(np.float64)]


def products(x: np.ndarray) -> np.ndarray:
    """x^T x of whole numbers, exact, as Python's integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for a in range(0, len(x), _ROWS):
        parts = _parts(x[a : a + _ROWS])
        for i, left in enumerate(parts):
            for j, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << _BITS * (i + j))
    return total


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            own = products(np.hstack([np.ones((len(x), 1), np.int64), x]))
            total = own if total is None else total + own
    if total is None:
        return
    d = len(total)
    cells = [(i, j, k, v) for i in range(d) for j in range(i, d) for k, v in exact.limbs(int(total[i, j]))]
    yield pa.RecordBatch.from_pydict(dict(zip("ijkv", (pa.array(c, pa.int64()) for c in zip(*cells, strict=True)), strict=True)))


def moments(vectors: DataFrame) -> Moments | None:
    """The moments of a column of integer vectors of one length; None without rows.

    Tasks add up their own rows; the partial sums, cut into parts of 32 bits, are added
    by Spark, so no sum overflows.
    """
    partial = vectors.mapInArrow(_partial_sums, "i long, j long, k long, v long")
    # At most a few parts for each pair of dimensions.
    cells = partial.groupBy("i", "j", "k").agg(F.sum("v").alias("v")).collect()
    if not cells:
        return None
    d = max(c.j for c in cells)
    whole = [[0] * (d + 1) for _ in range(d + 1)]
    for i, j, k, v in cells:
        whole[i][j] += v << (32 * k)
        if i != j:
            whole[j][i] += v << (32 * k)
    return Moments(whole[0][0], whole[0][1:], [row[1:] for row in whole[1:]])


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of the polynomial of a positive semidefinite matrix, the highest first."""
    primes = exact.primes_for(exact.coefficient_bound(matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            found = [exact.polynomial_modulo(matrix, p) for p in own]
            yield pa.RecordBatch.from_pydict({"p": pa.array(own, pa.int64()), "residues": pa.array(found, pa.list_(pa.int64()))})

    dealt = spark.createDataFrame([(p,) for p in primes], "p long")
    return exact.recombined({r.p: r.residues for r in dealt.mapInArrow(run, "p long, residues array<long>").collect()})


def _null_vectors(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[float]]:
    """The vectors of each root, one task a root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int64()), "vectors": [exact.null_vectors(matrix, *roots[at])]})

    dealt = spark.range(len(roots), numPartitions=max(1, len(roots)))
    found = dealt.mapInArrow(run, "at long, vectors array<array<double>>").collect()
    return [v for r in sorted(found, key=lambda r: r.at) for v in r.vectors]


def decompose(spark: SparkSession, found: Moments, components: int) -> Whitening:
    """The components of largest eigenvalue; those of eigenvalue 0 are none."""
    scatter = found.scatter()
    trace = sum(scatter[i][i] for i in range(len(scatter)))
    if not trace:
        return Whitening(found, [], [])
    polynomial = characteristic_polynomial(spark, scatter)
    roots = exact.largest_roots(polynomial, components, trace)
    vectors = _null_vectors(spark, scatter, roots)
    return Whitening(found, [root for root, m in roots for _ in range(m)][:components], vectors[:components])


def _project(model: Whitening):
    """(vec_id, x) to vec_id, deviation and whitened values, each row on its own."""
    n, sums = model.moments.n, model.moments.sums
    floor = np.array([s // n for s in sums], np.int64)
    over = [s % n for s in sums]
    rest = np.array([r / n for r in over])
    squared = sum(r * r for r in over)
    scales = np.array([n / exact.square_root(root) for root in model.roots])
    weights = np.array(model.vectors).reshape(len(model.roots), len(sums)).T * scales

    def deviations(y: np.ndarray) -> pa.Array:
        """Sums of (n y - over)^2, from the sums of y^2 and of y over, in whole numbers."""
        size = int(abs(y).max())
        kind = np.int64 if size * max(size, n) * y.shape[1] < 1 << 62 else object
        own, r = y.astype(kind), np.array(over, kind)
        squares, mixed = (own * own).sum(axis=1), (own * r).sum(axis=1)
        found = [n * n * a - 2 * n * b + squared for a, b in zip(squares.tolist(), mixed.tolist(), strict=True)]
        return pa.array([Decimal(v) if v < 10**38 else None for v in found], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            whole = x - floor
            centred = whole.astype(np.float64) - rest
            # Added dimension by dimension, so that equal vectors get equal values in any batch.
            white = np.zeros((len(x), len(model.roots)))
            for i in range(x.shape[1]):
                white += centred[:, i, None] * weights[i]
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column(0), "deviation": deviations(whole), "whitened": pa.ListArray.from_arrays(ends, white.ravel())}
            )

    return run


PROJECTED = "vec_id long, deviation decimal(38,0), whitened array<double>"


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    return vectors.select("vec_id", "x").mapInArrow(_project(model), PROJECTED)


def identity_error(fit_list: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity.

    Measured on the projected vectors, centred, divisor n; None without components.
    """
    if not model.roots:
        return None
    white = project(fit_list.select(F.lit(0).cast("long").alias("vec_id"), "x"), model)
    whole = F.transform("whitened", lambda w: F.round(w * _CHECK_STEP).cast("long"))
    found = moments(white.select(whole.alias("w")))
    unit = (found.n * _CHECK_STEP) ** 2
    cells = found.scatter()
    return max(abs(float(Fraction(c - (unit if i == j else 0), unit))) for i, row in enumerate(cells) for j, c in enumerate(row))


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector has only finite entries, as whole numbers.

    Vectors of another length than the commonest (ties: the longest) and empty ones
    go too, as do those with an entry of ``LARGEST`` or more, whose whole number is none.
    """
    rows = need_columns(embeddings, "vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.where(finite & (F.size("v") > 0))
    # One row for each length.
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    rows = rows.where(F.size("v") == (lengths[0].d if lengths else 0))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * STEPS) + ORIGIN).alias("x"))


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """Every usable vector projected on the first components, each scaled to variance 1.

    Means and covariance are those of the distinct vectors, divisor n. Returns vec_id, n
    (distinct vectors), deviation (sum over the dimensions of (n x - S)^2, exact; null
    from 10^38),
    whitened (one value a component), explained (each component's share of the trace)
    and identity_error (one value, see ``identity_error``).

    Vectors that are null, empty, hold null, non-finite or huge entries, or differ in
    length from the commonest go (see ``whole_vectors``). Equal vectors count once in the fit and are rows of
    their own in the result, as are null and repeated ids. Components of eigenvalue 0
    are left out, so one distinct vector alone has none. Components of equal eigenvalue
    are an orthonormal choice. Labels and further columns play no part. An empty table
    gives an empty result.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings)
    fit_list = stored(vectors.select("x").distinct(), "whitening")
    found = moments(fit_list)
    if found is None:
        return vectors.limit(0).selectExpr(
            "vec_id", "0L AS n", "CAST(0 AS decimal(38,0)) AS deviation", "CAST(array() AS array<double>) AS whitened",
            "CAST(array() AS array<double>) AS explained", "CAST(null AS double) AS identity_error",
        )
    model = decompose(spark, found, components)
    error = identity_error(fit_list, model)
    return project(vectors, model).select(
        "vec_id",
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in model.explained()]).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
