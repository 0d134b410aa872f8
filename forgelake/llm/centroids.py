"""Centroid clustering in integers with Shallot search.

Every vector remembers its centroid, the centroid that was second-nearest, an upper bound on the
distance to the one and a lower bound on the distance to all others. When centroids have moved, the
bounds are widened by as much. A vector whose upper bound is below its lower bound, or below half
the distance from its centroid to the next, stays without a distance being computed.

For the others the search starts at the closer of the two remembered centroids, ``s``. Other
centroids are taken in the order of their distance from ``s``. One that is nearer to the vector than
the second-nearest so far lies in a ball around ``s`` whose radius is the sum of the distances to
``s`` and to that second; each better second shrinks it, and the scan ends at the first centroid
outside. Bounds and balls are floating point with some slack and only decide what is looked at;
whatever is looked at is compared in integers, so that ties go to the smaller number.

A round is one pass over the vectors, which writes them with their new state, and one over those
that changed sides, whose integer sums move from the old centroid to the new one. What comes to the
driver is a row per centroid and component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import binary_parts, discard, scratch, table

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: Components of larger size would take squared distances beyond a long.
LARGEST = 1 << 27
#: Vectors looked at together, which bounds a task's memory.
BLOCK = 8192
SLACK = 1e-9

STATE = "x binary, was int, cluster int, second int, near double, far double"


@dataclass
class Centroids:
    """Integer centroids with what the search needs of them."""

    at: np.ndarray
    between: np.ndarray
    order: np.ndarray
    half: np.ndarray
    moved: np.ndarray
    others_moved: np.ndarray


def prepared(at: np.ndarray, before: np.ndarray | None = None) -> Centroids:
    k = len(at)
    # squares of whole numbers, rounded once
    between = np.sqrt(np.array([squared(at, np.broadcast_to(c, at.shape)) for c in at], float))
    order = np.array([[j for j in np.argsort(between[i], kind="stable") if j != i] for i in range(k)]).reshape(k, k - 1)
    half = between[np.arange(k), order[:, 0]] / 2 if k > 1 else np.full(k, np.inf)
    moved = np.zeros(k) if before is None else np.sqrt(squared(at, before).astype(float))
    others = np.array([max(np.delete(moved, i), default=0.0) for i in range(k)])
    return Centroids(at, between, order, half, moved, others)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, row by row, exact."""
    off = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", off, off)


def nearest(x: np.ndarray, cluster, second, near, far, c: Centroids) -> int:
    """Bring a block's state up to date in place; the number of distances computed."""
    if len(c.at) == 1:
        cluster[:] = 0
        return 0
    near += c.moved[cluster]
    far -= c.others_moved[cluster]

    def open_ones(rows: np.ndarray) -> np.ndarray:
        bound = np.maximum(far[rows], c.half[cluster[rows]])
        return rows[near[rows] >= bound - SLACK * (1 + np.abs(bound))]

    todo = open_ones(np.arange(len(x)))
    best2 = squared(x[todo], c.at[cluster[todo]])
    near[todo] = np.sqrt(best2.astype(float))
    still = open_ones(todo)
    best2 = best2[np.searchsorted(todo, still)]
    counted = len(todo) + len(still)
    if not len(still):
        return counted
    x, a, b = x[still], cluster[still].copy(), second[still].copy()
    second2 = squared(x, c.at[b])
    swap = (second2 < best2) | ((second2 == best2) & (b < a))
    a[swap], b[swap] = b[swap], a[swap]
    best2[swap], second2[swap] = second2[swap], best2[swap]
    start, other = a.copy(), b.copy()
    from_start = np.sqrt(best2.astype(float))
    for s in np.unique(start):
        inside = np.flatnonzero(start == s)
        for j in c.order[s]:
            ball = from_start[inside] + np.sqrt(second2[inside].astype(float))
            inside = inside[c.between[s, j] <= ball * (1 + SLACK) + SLACK]
            if not len(inside):
                break
            new = inside[other[inside] != j]
            counted += len(new)
            d2 = squared(x[new], np.broadcast_to(c.at[j], (len(new), c.at.shape[1])))
            first = (d2 < best2[new]) | ((d2 == best2[new]) & (j < a[new]))
            next_ = ~first & ((d2 < second2[new]) | ((d2 == second2[new]) & (j < b[new])))
            f, n = new[first], new[next_]
            second2[f], b[f] = best2[f], a[f]
            best2[f], a[f] = d2[first], j
            second2[n], b[n] = d2[next_], j
    cluster[still], second[still] = a, b
    near[still], far[still] = np.sqrt(best2.astype(float)), np.sqrt(second2.astype(float))
    return counted


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Packed vectors as rows of whole numbers, without copying."""
    offsets, data = binary_parts(column)
    return data[offsets[0] : offsets[-1]].view(np.int32).reshape(len(column), dimensions)


def packed(vectors: DataFrame, carried: list[str], dimensions: int) -> DataFrame:
    """``row``, a struct of the carried columns, and ``x``: the whole numbers of the vectors that count."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)
            whole = np.floor(SCALE * values)
            if len(whole) and np.abs(whole).max() >= LARGEST:
                raise ValueError(f"components must stay below {LARGEST / SCALE:.0f}: their squared distances would not fit a long")
            whole = whole.astype(np.int32).reshape(len(batch), dimensions)
            x = pa.array([w.tobytes() for w in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["row", "x"])

    finite = F.forall("vector", lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select(F.struct(*carried).alias("row"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter((F.size("vector") == dimensions) & finite)
    return rows.mapInArrow(pack, f"row {rows.schema['row'].dataType.simpleString()}, x binary")


def reassigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """The rows with the state that follows from these centroids."""
    dimensions = centroids.at.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), BLOCK):
                batch = whole.slice(first, BLOCK)
                was = batch.column("cluster").to_numpy()
                cluster, second, near, far = (batch.column(c).to_numpy().copy() for c in ("cluster", "second", "near", "far"))
                nearest(matrix(batch.column("x"), dimensions), cluster, second, near, far, centroids)
                if first_round:
                    was = np.full(len(batch), -1, np.int32)
                columns = [batch.column("row"), batch.column("x"), *(pa.array(v) for v in (was, cluster, second, near, far))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "x", "was", "cluster", "second", "near", "far"])

    first_round = "cluster" not in rows.columns
    if first_round:
        start = {"was": "-1", "cluster": "0", "second": str(min(1, len(centroids.at) - 1)), "near": "double('inf')", "far": "0D"}
        rows = rows.selectExpr("row", "x", *[f"{v} AS {n}" for n, v in start.items()])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {STATE}")


def changes(rows: DataFrame, clusters: int, dimensions: int) -> np.ndarray:
    """Per cluster the change of its number of vectors and of their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, dimensions + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), dimensions).astype(np.int64)
            x = np.c_[np.ones(len(x), np.int64), x]
            for column, sign in (("cluster", 1), ("was", -1)):
                side = batch.column(column).to_numpy()
                for c in range(clusters):
                    total[c] += sign * x[side == c].sum(axis=0)
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(total[c, d])], names=["c", "d", "v"]
        )

    moved = rows.filter("cluster <> was").select("x", "cluster", "was")
    sums = moved.mapInArrow(run, "c int, d int, v long").groupBy("c", "d").agg(F.sum("v").alias("v"))
    out = np.zeros((clusters, dimensions + 1), np.int64)
    for r in sums.collect():  # a row per centroid and component
        out[r.c, r.d] = r.v
    return out


def clustered(vectors: DataFrame, carried: list[str], clusters: int = CLUSTERS, rounds: int = ROUNDS,
              dimensions: int = DIMENSIONS) -> DataFrame:
    """The carried columns plus cluster, distance, cluster_inertia, inertia and centroid_sha256.

    A row per row of ``vectors`` (vec_id, embedding) whose embedding has the right number of
    components, none of them NULL or not finite; others have none. Repeated rows count as often as
    they stand. A NULL vec_id is hashed as empty text. With fewer vectors than ``clusters`` each is
    a centroid; equal ones leave those of larger number empty. No vectors give an empty result.
    Carried columns named like those added give way.
    """
    spark = vectors.sparkSession
    added = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    kept = [c for c in carried if c not in added]
    vectors = vectors.withColumn("v_hash", F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    rows = vectors.select(F.struct(*kept).alias("own"), "v_hash", "embedding")
    path = scratch(spark, "vectors")
    packed(rows, ["own", "v_hash"], dimensions).write.parquet(path)
    state = spark.read.parquet(path)
    drawn = state.orderBy("row.v_hash", "x").select("x").limit(clusters).collect()
    at = np.array([np.frombuffer(r.x, np.int32) for r in drawn], np.int64).reshape(len(drawn), dimensions)
    state = state.select("row.own", "x").withColumnRenamed("own", "row")
    if not drawn:
        result = state.selectExpr("row.*", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
        return result
    totals, before = np.zeros((len(at), dimensions + 1), np.int64), None
    for number in range(rounds + 1):
        centroids, older = prepared(at, before), path
        path = scratch(spark, "clusters")
        reassigned(state, centroids).write.parquet(path)
        discard(spark, older)  # only the state before this one was read from it
        state = spark.read.parquet(path)
        if number < rounds:
            totals += changes(state, len(at), dimensions)
            full = totals[:, :1] > 0
            before, at = at, np.where(full, totals[:, 1:] // np.maximum(totals[:, :1], 1), at)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster")
            d2 = squared(matrix(batch.column("x"), dimensions), at[cluster.to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column("row"), cluster, pa.array(d2)], names=["row", "cluster", "distance"])

    schema = f"row {state.schema['row'].dataType.simpleString()}, cluster int, distance long"
    measured = state.select("row", "x", "cluster").mapInArrow(measure, schema)
    inertia = measured.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("v"))
    inertia = {r.cluster: int(r.v) for r in inertia.collect()}  # a row per centroid
    text = [(c, v, sum(inertia.values()), ",".join(map(str, at[c]))) for c, v in inertia.items()]
    facts = spark.createDataFrame(text, "of int, cluster_inertia long, inertia long, components string")
    facts = facts.select("of", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256"))
    # as many rows as there are centroids
    found = measured.join(F.broadcast(facts), F.col("cluster") == F.col("of"))
    return found.select("row.*", *added)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), ["vec_id"])


def _sql() -> str:
    """The rounds written out one after the other."""
    steps = [f"""
vecs AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
long AS MATERIALIZED (SELECT vec_id, unnest(x) AS v, unnest(range(1, {DIMENSIONS + 1})) AS d FROM vecs),
first AS (
  SELECT x, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR)) - 1 AS c FROM vecs
  QUALIFY c < {CLUSTERS}),
at0 AS MATERIALIZED (SELECT c, unnest(x) AS v, unnest(range(1, {DIMENSIONS + 1})) AS d FROM first)"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
off{r} AS (
  SELECT l.vec_id, a.c, sum((l.v - a.v) * (l.v - a.v)) AS s FROM long l JOIN at{r} a ON l.d = a.d GROUP BY l.vec_id, a.c),
own{r} AS MATERIALIZED (
  SELECT vec_id, c, s FROM off{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} AS (
  SELECT o.c, l.d, sum(l.v) AS s, count(*) AS n FROM own{r} o JOIN long l ON l.vec_id = o.vec_id GROUP BY o.c, l.d),
at{r + 1} AS MATERIALIZED (
  SELECT a.c, a.d, coalesce(((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT, a.v) AS v
  FROM at{r} a LEFT JOIN mean{r} m ON a.c = m.c AND a.d = m.d)""")
    return "WITH " + ",".join(steps) + f""",
named AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM at{ROUNDS} GROUP BY c)
SELECT o.vec_id, o.c::INTEGER AS cluster, o.s::BIGINT AS distance,
       (sum(o.s) OVER (PARTITION BY o.c))::BIGINT AS cluster_inertia, (sum(o.s) OVER ())::BIGINT AS inertia, centroid_sha256
FROM own{ROUNDS} o JOIN named n ON o.c = n.c
"""


SQL = _sql()
