"""Centroid clustering in whole numbers, with Ptolemaic lower bounds.

For any four points Ptolemy's inequality gives ``d(x, c) d(p, s) >= |d(x, p) d(c, s) -
d(x, s) d(c, p)|``. The distances of every vector to a few fixed pivots are computed once
and stored beside it; the distances of the centroids to the pivots are a small matrix.
A centroid whose bound, rounded down, lies above the distance of a centroid already
checked exactly cannot be nearest. All that remain are checked exactly in whole numbers,
so the bounds save work and change no result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import kept_table
from marinelake.llm.registry import query, table
from marinelake.llm.vectors import matrix, number_type

CENTROIDS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
#: Components up to this size keep every sum of squares of 64 differences in 63 bits.
NARROW = 1 << 27
#: Bits of a limb of a sum. Sums of up to 2^22 tasks of one limb each fit in 63 bits.
LIMB = 40
#: Rounding errors of a bound, relative to its terms, are far below this.
SLACK = 2.0**-40
#: Vectors that a task works on at once.
ROWS = 4096
PLACED = "vec_id bigint, cluster int, distance bigint"


def whole(x: float) -> int:
    """``floor(SCALE * x)`` exactly; a double of 2^53 or more is whole already."""
    return math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE


def scaled(values: np.ndarray, narrow: bool) -> np.ndarray:
    """The vectors in whole numbers: 64-bit ones, or Python's where those could overflow."""
    if narrow:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([whole(x) for x in values.ravel().tolist()], object).reshape(values.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    return ((a - b) ** 2).sum(axis=-1)


def as_float(squares: np.ndarray) -> np.ndarray:
    """Squared distances as doubles; what no double holds becomes 2^1000."""
    if squares.dtype == object:
        squares = np.minimum(squares, 1 << 1000)
    return squares.astype(np.float64)


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances of all points to a few others, correct up to a few roundings."""
    found = np.empty((len(points), len(others)))
    for j, other in enumerate(others):
        found[:, j] = np.sqrt(as_float(squared(points, other)))
    return found


def pivot_pairs(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pivot with the one farthest from it, and their distance; equal pivots pair
    not, nor do pivots whose squared distances no double holds."""
    apart = distances(pivots, pivots)
    other = apart.argmax(axis=1)
    length = apart[np.arange(len(pivots)), other]
    kept = np.flatnonzero((length > 0) & (length < 2.0**480))
    return kept, other[kept], length[kept]


def lower_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, pairs) -> np.ndarray:
    """Bounds below the squared distances of vectors (rows) to centroids (columns).

    Every rounding is made good for by ``SLACK`` of the terms, downwards."""
    best = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    for p, s, apart in zip(*pairs):
        one = to_pivots[:, p, None] * centroid_to_pivots[None, :, s]
        two = to_pivots[:, s, None] * centroid_to_pivots[None, :, p]
        np.maximum(best, (np.abs(one - two) - SLACK * (one + two)) / (apart * (1 + SLACK)), out=best)
    return best * best * (1 - SLACK)


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_to_pivots: np.ndarray, pairs):
    """Number and exact squared distance of the nearest centroid, ties to the smaller
    number, and how many exact distances it took."""
    bounds = lower_bounds(to_pivots, centroid_to_pivots, pairs)
    best = bounds.argmin(axis=1)
    distance = squared(vectors, centroids[best])
    first = best.copy()
    checked = len(vectors)
    for c in range(len(centroids)):
        at = np.flatnonzero((first != c) & (bounds[:, c] <= as_float(distance) * (1 + SLACK)))
        if len(at):
            found = squared(vectors[at], centroids[c])
            better = (found < distance[at]) | ((found == distance[at]) & (c < best[at]))
            best[at[better]], distance[at[better]] = c, found[better]
            checked += len(at)
    return best, distance, checked


def _limbs(value: int, count: int) -> list[int]:
    """The parts of a whole number to the base ``2**LIMB``, all of its sign."""
    if count == 1:
        return [value]
    sign, rest = (-1, -value) if value < 0 else (1, value)
    return [sign * ((rest >> (LIMB * i)) & ((1 << LIMB) - 1)) for i in range(count)]


class Clusters:
    """The stored vectors with their pivot distances, and what a round needs."""

    def __init__(self, stored: DataFrame, pivots: np.ndarray, narrow: bool, limbs: int):
        self.stored, self.pivots, self.narrow, self.limbs = stored, pivots, narrow, limbs
        self.pairs = pivot_pairs(pivots)

    def _assigner(self, centroids: np.ndarray):
        """A function from an Arrow batch to its vectors, clusters and distances."""
        pivots, pairs, narrow = self.pivots, self.pairs, self.narrow
        centroid_to_pivots = distances(centroids, pivots)

        def assign(batch: pa.RecordBatch):
            values = matrix(batch.column("v"))
            vectors = scaled(values, narrow)
            to_pivots = np.frombuffer(b"".join(batch.column("p").to_pylist()), "<f8").reshape(batch.num_rows, -1)
            best, distance, _ = nearest(vectors, to_pivots, centroids, centroid_to_pivots, pairs)
            return vectors, best, distance

        return assign

    def sums(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of each cluster and the sums of their components, exactly.

        Every task adds up what it holds and sends one row per cluster and limb; Spark
        adds the rows, and the driver gets one number per cluster, component and limb."""
        assign, limbs = self._assigner(centroids), self.limbs
        k, d = centroids.shape

        def add(batches):
            count, total = np.zeros(k, np.int64), np.zeros((k, d), object)
            for batch in _parts(batches):
                vectors, best, _ = assign(batch)
                for c in np.unique(best):
                    own = vectors[best == c]
                    count[c] += len(own)
                    total[c] += own.sum(axis=0).astype(object)
            used = np.flatnonzero(count)
            split = [[_limbs(int(x), limbs) for x in total[c]] for c in used]
            rows = [(int(c), i, int(count[c]) if i == 0 else 0, [x[i] for x in split[n]]) for n, c in enumerate(used) for i in range(limbs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))],
                ["cluster", "limb", "n", "part"],
            )

        parts = self.stored.select("v", "p").mapInArrow(add, "cluster int, limb int, n bigint, part array<bigint>")
        totals = parts.select("cluster", "limb", "n", F.posexplode("part").alias("i", "x")).groupBy("cluster", "limb", "i").agg(F.sum("n"), F.sum("x"))
        count, total = np.zeros(k, object), np.zeros((k, d), object)
        for cluster, limb, i, n, x in totals.collect():
            count[cluster] += n if i == 0 else 0
            total[cluster, i] += x << (LIMB * limb)
        return count, total

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round; those of empty clusters stay."""
        count, total = self.sums(centroids)
        new = centroids.copy()
        for c in np.flatnonzero(count):
            new[c] = [x // count[c] for x in total[c]]
        return new

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """``vec_id, cluster, distance``; a distance above 63 bits is null."""
        assign = self._assigner(centroids)

        def place(batches):
            for batch in _parts(batches):
                _, best, distance = assign(batch)
                found = pa.array([x if x < 1 << 63 else None for x in distance.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best, pa.int32()), found], ["vec_id", "cluster", "distance"])

        return self.stored.mapInArrow(place, PLACED)


def _parts(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def cluster_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every
    vector with exactly ``dimensions`` components, all finite; other rows are left out.

    Components become ``floor(1024 * x)``. The first centroids are the vectors with the
    smallest sha256 of ``seed:vec_id``, fewer where there are fewer vectors; rows that
    share an id are ordered by their components. Rows without an id are clustered, but
    are first centroids only where others lack. Repeated rows count as often as they come.
    No vectors, no rows. Distances and sums are exact at any size of components; one that
    does not fit in a bigint is null.

    A round is one pass over a stored table: no row is shuffled, a task sends one row of
    sums per cluster, and the driver gets one row per cluster.
    """
    spark: SparkSession = vectors.sparkSession
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kind = "float" if number_type(vectors, embedding) == "<f4" else "double"
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("v")).where(F.coalesce((F.size("v") == dimensions) & finite, F.lit(False)))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(key.asc_nulls_last(), "v").limit(centroids).collect()
    if not first:
        return spark.createDataFrame([], f"{PLACED}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    n, largest = rows.agg(F.count(F.lit(1)), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    bits = (whole(largest) * n).bit_length()
    narrow, limbs = largest * SCALE < NARROW, 1 if bits < 62 else bits // LIMB + 1
    starts = scaled(np.array([r["v"] for r in first]), narrow)

    stored = kept_table(_with_pivot_distances(rows, starts, narrow), "vectors")
    clusters, now = Clusters(stored, starts, narrow, limbs), starts
    for _ in range(rounds):
        now = clusters.moved(now)
    placed = kept_table(clusters.assigned(now), "clustered")

    # One row per cluster: their number is a parameter.
    wide = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("none"))
    inertia = {r["cluster"]: None if r["none"] else int(r["s"]) for r in wide.collect()}
    total = None if None in inertia.values() else sum(inertia.values())

    def fits(value: int | None) -> int | None:
        return value if value is not None and value < 1 << 63 else None

    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in now]
    about = spark.createDataFrame(
        [(c, fits(s), fits(total), digests[c]) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return placed.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _with_pivot_distances(rows: DataFrame, pivots: np.ndarray, narrow: bool) -> DataFrame:
    """``vec_id, v`` and ``p``, the distances to the pivots as doubles in bytes."""

    def measure(batches):
        for batch in _parts(batches):
            values = matrix(batch.column("v"))
            found = distances(scaled(values, narrow), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in found], pa.binary())], ["vec_id", "v", "p"])

    return rows.mapInArrow(measure, rows.withColumn("p", F.lit(b"")).schema)


def _oracle(rounds: int = ROUNDS) -> str:
    """The rounds as one common table each, in whole numbers."""
    steps = [
        f"""WITH kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {DIMENSIONS}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS c, v
            FROM kept QUALIFY c < {CENTROIDS}
        )"""
    ]
    assign = """SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT k.rowid_ AS r, k.vec_id, k.v, m.c,
                   list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM (SELECT *, row_number() OVER () AS rowid_ FROM kept) k, {centroids} m) GROUP BY r, vec_id, v"""
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({assign.format(centroids=f"c{i}")}),
        m{i} AS (SELECT c, list(mean ORDER BY i) AS v FROM (
            SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS mean
            FROM (SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS n
                  FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)) GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    steps.append(f"placed AS ({assign.format(centroids=f'c{rounds}')})")
    return (
        ",\n".join(steps)
        + f"""
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM placed JOIN c{rounds} USING (c)"""
    )


@query("op12_centroid_clustering", _oracle())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))
