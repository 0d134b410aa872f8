"""Embedding whitening: covariance on Spark, its leading eigenvectors by bisection, a projection.

Vectors become whole numbers. Each distinct one counts once: exact integer sums give the mean, and
a second pass adds up the products of centred vectors, a triangle of numbers per task. The
symmetric matrix, whose size is that of a vector and not of the table, is brought to tridiagonal
form by Householder reflections. Sturm counts say how many eigenvalues lie below a number, and
bisection on them finds the leading ones; inverse iteration finds their vectors, made orthogonal
again within clusters of close eigenvalues. The few vectors are broadcast and every row is
projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import stored, table

SCALE = 256
COMPONENTS = 4
#: Eigenvalues below this share of the trace are rounding: nothing varies in their direction.
LEAST_SHARE = 1e-12
#: Eigenvalues closer than this share of the matrix' norm are a cluster.
CLUSTER = 1e-3
INVERSE_STEPS = 6
EPS = float(np.finfo(float).eps)

OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal, and the unit vectors of the reflections (zero where none was needed)."""
    a, n = matrix.astype(float).copy(), len(matrix)
    mirrors = []
    for i in range(n - 2):
        v = a[i + 1 :, i].copy()
        length = np.linalg.norm(v)
        v[0] += np.copysign(length, v[0])
        size = np.linalg.norm(v)
        if size > 0:
            v /= size
            rest = a[i + 1 :, i + 1 :]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[i + 1, i] = -np.copysign(length, a[i + 1, i])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are smaller than each of the values."""
    tiny = np.finfo(float).tiny / EPS
    q = diagonal[0] - values
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        with np.errstate(over="ignore"):
            q = d - values - e * e / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection to the last bit."""
    n = len(diagonal)
    reach = np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off])
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    high += EPS * np.abs(high) + np.finfo(float).tiny
    wanted = n - np.arange(1, count + 1)  # so many are smaller
    while True:
        middle = low + (high - low) / 2
        inside = (middle > low) & (middle < high) & (high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if not inside.any():
            return middle
        up = below(diagonal, off, middle) <= wanted
        low, high = np.where(inside & up, middle, low), np.where(inside & ~up, middle, high)


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; pivots are ``least`` at least."""
    n = len(diagonal)
    d, u, w, y = diagonal - shift, np.r_[off, 0.0], np.zeros(n), right.copy()
    for i in range(n - 1):
        if abs(off[i]) > abs(d[i]):
            # the row below comes first
            row = (off[i], d[i + 1], u[i + 1])
            factor = d[i] / row[0]
            d[i + 1], u[i + 1] = u[i] - factor * row[1], -factor * row[2]
            d[i], u[i], w[i] = row
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            factor = off[i] / d[i]
            d[i + 1] -= factor * u[i]
            y[i + 1] -= factor * y[i]
    for i in range(n - 1, -1, -1):
        if abs(d[i]) < least:
            d[i] = least
        rest = y[i]
        if i + 1 < n:
            rest -= u[i] * y[i + 1]
        if i + 2 < n:
            rest -= w[i] * y[i + 2]
        y[i] = rest / d[i]
        if abs(y[i]) > 1e150:
            y /= abs(y[i])
    return y


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors as columns."""
    n = len(matrix)
    count = min(count, n)
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, off, count)
    norm = np.abs(diagonal).max() + 2 * np.abs(np.r_[off, 0.0]).max()
    least, start = max(EPS * norm, np.finfo(float).tiny), np.random.default_rng(1)
    vectors = np.zeros((n, count))
    for k in range(count):
        # the cluster: neighbours that follow one another closely
        first = k
        while first > 0 and values[first - 1] - values[first] <= CLUSTER * norm:
            first -= 1
        v = start.standard_normal(n)
        for _ in range(INVERSE_STEPS):
            v = solved(diagonal, off, values[k], v / np.linalg.norm(v), least)
            for _ in range(2):
                v /= np.linalg.norm(v)
                v -= vectors[:, first:k] @ (vectors[:, first:k].T @ v)
        vectors[:, k] = v / np.linalg.norm(v)
    for i in range(n - 3, -1, -1):
        part = vectors[i + 1 :]
        part -= 2 * np.outer(mirrors[i], mirrors[i] @ part)
    return values, vectors / np.linalg.norm(vectors, axis=0)


def whole_numbers(vectors: DataFrame, carried: list[str]) -> tuple[DataFrame, int]:
    """``row``, a struct of the carried columns, and ``x``, of the rows that count; the length of x. Written."""
    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select(F.struct(*carried).alias("row"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & finite)
    rows = stored(rows.select("row", F.transform("vector", lambda c: F.floor(SCALE * c)).alias("x")), "whole")
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    size = common.size if common else 0
    return rows.filter(F.size("x") == size), size


def block(batch: pa.RecordBatch, size: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(len(batch), size)


def exact_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (size + 1)
        for batch in batches:
            x = block(batch, size)
            # halves of the numbers, so that no sum leaves a long
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            totals[0] += len(x)
            for i in range(size):
                totals[i + 1] += (int(high[i]) << 32) + int(low[i])
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(map(str, totals))], names=["at", "v"])

    sums = fit.mapInArrow(run, "at int, v string").groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r["at"]: int(r.v) for r in sums.collect()}  # a row per component
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(size)]


def products(fit: DataFrame, mean: np.ndarray, n: int, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the vectors, or of their projections, centred before they are multiplied."""
    size = len(mean)
    width = size if project is None else project.shape[1]
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            z = block(batch, size) - mean
            z = z if project is None else z @ project
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], names=["at", "v"])

    sums = fit.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in sums.collect():  # a row per pair of components
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        out[i, j] = out[j, i] = r.v / n
    return out


def whitened(vectors: DataFrame, carried: list[str], components: int = COMPONENTS) -> DataFrame:
    """The carried columns plus component, n, deviation, whitened, explained and identity_error.

    A row per component and row of ``vectors`` (embedding) that counts. Rows whose embedding is NULL
    or holds a NULL or an entry that is not finite do not; nor do, in a table of mixed lengths, those
    of another length than most. Components in whose direction nothing varies (all of them, if all
    vectors are equal) have no rows. Repeated rows are projected as often as they stand, but fitted
    once. A deviation beyond a long is NULL. Carried columns named like those added give way. An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    added = [c.split()[0] for c in OUT.split(", ")]
    rows, size = whole_numbers(vectors, [c for c in carried if c not in added])
    kind = rows.schema["row"].dataType.simpleString()
    # equal vectors meet once per task before they are shuffled
    fit = stored(rows.select("x").distinct(), "fit")
    n, sums = exact_sums(fit, size)
    mean = np.array([s / n for s in sums]) if n else np.zeros(size)
    cov = products(fit, mean, n) if n else np.zeros((size, size))
    trace = float(np.trace(cov))
    values, units = leading(cov, components) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    real = values > LEAST_SHARE * trace
    values, units = values[real], units[:, real]
    if not len(values):
        return spark.createDataFrame([], f"row {kind}, {OUT}").select("row.*", *added)
    scaled = units / np.sqrt(values)
    error = float(np.abs(products(fit, mean, n, scaled) - np.eye(len(values))).max())
    shared = spark.sparkContext.broadcast((mean, scaled, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, scaled, sums = shared.value
        count = scaled.shape[1]
        for batch in batches:
            x = block(batch, size)
            white = (x - mean) @ scaled
            most = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums))
            kind = np.int64 if size * most * most < 1 << 63 else object
            off = n * x.astype(kind) - np.array(sums, kind)
            away = (off * off).sum(axis=1)
            away = [int(v) if v < 1 << 63 else None for v in away]
            each = pa.array(np.repeat(np.arange(len(batch)), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(batch))),
                    pa.array(away, pa.int64()).take(each), pa.array(white.ravel()),
                ],
                names=["row", "component", "deviation", "whitened"],
            )

    found = rows.mapInArrow(run, f"row {kind}, component int, deviation long, whitened double")
    explained = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values]), F.col("component"))
    return found.select(
        "row.*", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), ["vec_id"])
