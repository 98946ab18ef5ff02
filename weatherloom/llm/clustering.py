"""Clusters around centroids, with centroids filtered by n-simplex projection.

Vectors are turned into integers. The squared distances of each vector to a few
pivots are computed once and kept beside it in a written table. The pivots and
the last kept distance span a simplex: the distances of a point become its apex
coordinates, those in the pivots' span and its height above it. Between two
points the distance of their apexes is a lower bound of the Euclidean distance,
and the distance with one height turned over an upper bound. In every round a
task bounds the distances of its vectors to all centroids this way, leaves out a
centroid whose lower bound is above the lowest upper bound, and compares exact
integer distances of those that are left.

Bounds are floating point and therefore widened by ``SLACK`` of the squared
distances they come from, so that rounding leaves out no nearest centroid and no tie.
Centroids, at most ``clusters`` times ``size`` integers, are all that passes through the driver;
sums for new ones are made inside each task first, one row per task and cluster.

Rows whose vector is null, has another length, or a component that is null, NaN
or infinite are not kept. Components beyond 2**27 in size count as 2**27, so that
a squared distance fits 64 bits. Repeated rows are vectors of their own and count
as often; equal distances go to the centroid with the smaller number, equal
hashes of ids (repeated ids) to the smaller vector, and rows without an id come last when the first
centroids are drawn. With fewer vectors than ``clusters`` there are as many centroids as
vectors; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from weatherloom.session import cut_lineage

CLUSTERS, ROUNDS, SIZE, SCALE, SEED = 40, 5, 64, 256, 2
PIVOTS = 32
LARGEST = 1 << 27
#: Share of a squared distance by which bounds are widened.
SLACK = 1e-5
#: A pivot must stand this high above the span of the others, as a share of the squared distances among pivots.
FLAT = 1e-3
#: Vectors compared at a time.
STEP = 4096


def kept(df: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer components of every usable vector."""
    numbers = df.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    numbers = numbers.filter((F.size("v") == size) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def whole(x):  # noqa: ANN001, ANN202
        return F.floor(F.least(F.greatest(x * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int")

    return numbers.select("vec_id", F.transform("v", whole).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in the order of these."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(by_hash.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(clusters)
    rows = first.collect()  # at most ``clusters``
    return np.array([r["v"] for r in rows], np.int64)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances: a row per vector, a column per point."""
    out = np.empty((len(vectors), len(points)), np.int64)
    for j, point in enumerate(points):
        gap = vectors - point
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


class Simplex:
    """Pivots, and the change from squared distances to apex coordinates."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS) -> None:
        chosen, base = _spread(candidates, most)
        self.pivots = candidates[chosen]
        self.base = base  # row i: coordinates of pivot i + 1 in the span, lower triangular
        self.inverse = np.linalg.inv(base) if len(base) else base
        self.norms = (base * base).sum(axis=1)

    def apex(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the span and heights above it, from squared distances to the pivots.

        Of a point x, |x|^2 + |p|^2 - |x - p|^2 is twice its product with pivot p, and the
        pivots' rows are triangular.
        """
        d = distances.astype(np.float64)
        products = (d[:, :1] + self.norms - d[:, 1:]) / 2
        inside = products @ self.inverse.T
        return inside, np.sqrt(np.maximum(d[:, 0] - (inside * inside).sum(axis=1), 0))


def _spread(points: np.ndarray, most: int) -> tuple[list[int], np.ndarray]:
    """Numbers of points that stand far above each other's span, the first one first, and their triangular coordinates."""
    chosen = [0]
    moved = (points - points[0]).astype(np.float64)
    inside = np.zeros((len(points), 0))
    height = (moved * moved).sum(axis=1)
    floor = FLAT * height.max()
    while len(chosen) < min(most, len(points)):
        best = int(height.argmax())
        if height[best] <= floor:
            break
        axis = moved[best] / np.sqrt((moved[best] ** 2).sum())
        along = moved @ axis
        moved = moved - along[:, None] * axis
        again = moved @ axis  # a second time, against rounding
        moved = moved - again[:, None] * axis
        inside = np.column_stack([inside, along + again])
        height = (moved * moved).sum(axis=1)
        height[best] = 0
        chosen.append(best)
    return chosen, inside[chosen[1:]]


def nearest(vectors: np.ndarray, distances: np.ndarray, centroids: np.ndarray, simplex: Simplex, apexes: tuple) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of each vector's nearest centroid, and how many exact distances that took."""
    inside, height = simplex.apex(distances)
    other, tall = apexes
    flat = (inside * inside).sum(axis=1)[:, None] + (other * other).sum(axis=1) - 2 * inside @ other.T
    flat = np.maximum(flat, 0)
    lowest = flat + (height[:, None] - tall) ** 2
    highest = flat + (height[:, None] + tall) ** 2
    room = SLACK * ((inside * inside).sum(axis=1) + height**2)[:, None] + SLACK * ((other * other).sum(axis=1) + tall**2) + 1
    open_ = lowest - room <= (highest + room).min(axis=1)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    number = np.zeros(len(vectors), np.int32)
    for c in range(len(centroids)):
        rows = np.flatnonzero(open_[:, c])
        gap = vectors[rows] - centroids[c]
        exact = np.einsum("ij,ij->i", gap, gap)
        better = exact < best[rows]  # an equal one has a larger number
        best[rows[better]], number[rows[better]] = exact[better], c
    return number, best, int(open_.sum())


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP):
            part = batch.slice(start, STEP)
            yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _rows(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1] or 1, np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel()))


def with_distances(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """The vectors with their squared distances to the pivots; written, as every round reads them."""
    size = simplex.pivots.shape[1]
    schema = StructType([*vectors.schema.fields, StructField("d", ArrayType(LongType()))])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _parts(batches, size):
            yield pa.RecordBatch.from_arrays([*part.columns, _rows(squared(v, simplex.pivots))], schema=target)

    return cut_lineage(vectors.mapInArrow(run, schema))


def _compared(simplex: Simplex, centroids: np.ndarray):  # noqa: ANN202
    """A function over record batches that yields each part with its vectors, numbers and distances."""
    size, apexes = simplex.pivots.shape[1], simplex.apex(squared(centroids, simplex.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, v in _parts(batches, size):
            d = part.column("d").flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
            yield part, v, *nearest(v, d, centroids, simplex, apexes)[:2]

    return run


def moved(table: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """One round: every vector to its nearest centroid, every centroid that has any to the floor of their mean."""
    compared, (k, size) = _compared(simplex, centroids), centroids.shape
    schema = "cluster int, n bigint, " + ", ".join(f"s{i} bigint" for i in range(size))
    target = to_arrow_schema(table.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, v, number, _ in compared(batches):
            n += np.bincount(number, minlength=k)
            for c in np.unique(number):
                sums[c] += v[number == c].sum(axis=0)
        own = np.flatnonzero(n)
        if len(own):
            columns = [own.astype(np.int32), n[own], *sums[own].T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], schema=target)

    parts = table.select("v", "d").mapInArrow(run, schema)
    names = ["n", *[f"s{i}" for i in range(size)]]
    # sums of a task fit 64 bits, those of all tasks need not
    sums = parts.groupBy("cluster").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names])
    out = centroids.copy()
    for row in sums.collect():  # at most one row per cluster
        out[row["cluster"]] = [int(row[c]) // int(row["n"]) for c in names[1:]]
    return out


def assigned(table: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    compared = _compared(simplex, centroids)
    schema = StructType([table.schema["vec_id"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, best in compared(batches):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(number), pa.array(best)], schema=target)

    return table.mapInArrow(run, schema)


def clustered(
    df: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = df.sparkSession
    vectors = kept(df, size, scale)
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        nothing = vectors.limit(0).select("vec_id", F.lit(0).alias("cluster"))
        big = [F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")]
        return nothing.select("vec_id", "cluster", *big, F.lit("").alias("centroid_sha256"))
    simplex = Simplex(centroids, pivots)
    table = with_distances(vectors, simplex)
    for _ in range(rounds):
        centroids = moved(table, simplex, centroids)
    rows = cut_lineage(assigned(table, simplex, centroids))
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(r["cluster"], int(r["s"]), total, digests[r["cluster"]]) for r in sums]
    # one row per cluster
    facts_df = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts_df), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
