"""Nearest neighbours by stable projections.

Vectors are projected to a few dimensions by a Gaussian matrix. Projected points lie
in regions of a kd-tree; a query first searches its own region, then every region
that the stopping test leaves open. In a region a kd-tree gives projected neighbours
in ascending order, each is verified on the original vectors, and the search ends
when the chi-square test says that a nearer one is unlikely to come.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import kept_table
from marinelake.llm.registry import query, table
from marinelake.llm.vectors import by_length, common_lengths, drawn, matrix, number_type, unpacked, usable

NEIGHBOURS = 10
DIMENSIONS = 8
#: Confidence of the stopping test: a true neighbour is lost with 1 - this probability.
CONFIDENCE = 0.975
#: Vectors that the regions are cut by, at most; every vector is indexed.
FITTED = 20_000
REGION_ROWS = 8192
MAX_REGIONS = 4096
#: Rows of one block of a region; a region of more rows (ties) has several blocks.
BLOCK_ROWS = 16_384
QUERIES_PER_BLOCK = 1024
LEAF = 32
_LAST = np.iinfo(np.int64).max


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, where the distribution has a closed form."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        x = (lo + hi) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2)) < p
        lo, hi = (x, hi) if below else (lo, x)
    return (lo + hi) / 2


def _halves(points: np.ndarray, rows: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
    """Cut at the median of the widest dimension; rows keep their order."""
    own = points[rows]
    axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
    cut = float(np.median(own[:, axis]))
    low = own[:, axis] < cut
    return axis, cut, rows[low], rows[~low]


def projection(length: int, dimensions: int) -> np.ndarray:
    """The Gaussian matrix of a length of vector, the same in every task."""
    return np.random.default_rng(13).normal(size=(length, dimensions))


class Regions:
    """The projection and boxes that cover the projected space."""

    def __init__(self, sample: np.ndarray, total: int, dimensions: int):
        self.projection = projection(sample.shape[1], dimensions)
        points = sample @ self.projection
        wanted = min(MAX_REGIONS, max(1, -(-total // REGION_ROWS)))
        self.cuts: list[tuple[int, int, float, int]] = []  # region, axis, cut, new region
        rows, boxes = [np.arange(len(points))], [np.array([[-np.inf] * dimensions, [np.inf] * dimensions])]
        while len(rows) < wanted:
            at = max(range(len(rows)), key=lambda r: len(rows[r]))
            if len(rows[at]) < 2:
                break
            axis, cut, low, high = _halves(points, rows[at])
            if not len(low) or not len(high):
                break
            upper = boxes[at].copy()
            boxes[at][1, axis], upper[0, axis] = cut, cut
            self.cuts.append((at, axis, cut, len(rows)))
            rows[at] = low
            rows.append(high)
            boxes.append(upper)
        self.boxes = np.array(boxes)

    def region(self, projected: np.ndarray) -> np.ndarray:
        own = np.zeros(len(projected), np.int64)
        for old, axis, cut, new in self.cuts:
            own[(own == old) & (projected[:, axis] >= cut)] = new
        return own

    def squared_distances(self, projected: np.ndarray) -> np.ndarray:
        out = np.zeros((len(projected), len(self.boxes)))
        for a in range(projected.shape[1]):
            x = projected[:, a, None]
            away = np.maximum(np.maximum(self.boxes[None, :, 0, a] - x, x - self.boxes[None, :, 1, a]), 0)
            out += away * away
        return out


class KdTree:
    """Leaves of a kd-tree with their boxes; neighbours come leaf by leaf."""

    def __init__(self, points: np.ndarray):
        pending, leaves = [np.arange(len(points))], []
        while pending:
            rows = pending.pop()
            if len(rows) > LEAF:
                _, _, low, high = _halves(points, rows)
                if len(low) and len(high):
                    pending += [high, low]
                    continue
            leaves.append(rows)
        self.leaves = leaves
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])

    def search(self, point: np.ndarray, verify, bound: float, limit: float) -> None:
        """``verify(rows)`` returns the squared distance of the farthest neighbour kept;
        leaves come in ascending projected distance until ``limit`` times that is less."""
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        away = (away * away).sum(axis=1)
        order, done, step = np.argsort(away, kind="stable"), 0, 1
        while done < len(order):
            part = order[done : done + step]
            part = part[away[part] <= limit * bound]
            if not len(part):
                return
            bound = min(bound, verify(np.concatenate([self.leaves[i] for i in part])))
            done, step = done + step, min(2 * step, 64)


def _searched(kind: str, k: int, confidence: float, dimensions: int):
    """A function from a block of stored and seeking rows to the nearest found there."""

    def search(block):
        seeks = block.column("seeks").to_numpy()
        v = unpacked(block.column("v").to_pylist(), kind)
        ids, bounds = block.column("vec_id").fill_null(_LAST).to_numpy(), block.column("bound").to_numpy()
        stored, own = v[~seeks], ids[~seeks]
        order = np.argsort(own, kind="stable")
        stored, own = stored[order], own[order]
        own_projection = projection(v.shape[1], dimensions)
        tree = KdTree(stored @ own_projection) if len(stored) else None
        limit, rows = chi_square_quantile(confidence, dimensions), []
        for x, i, bound, key in zip(v[seeks], ids[seeks], bounds[seeks], [b for b, s in zip(block.column("qkey").to_pylist(), seeks) if s]):
            if tree is None:
                continue
            best = [np.zeros(0), np.zeros(0, np.int64)]

            def verify(at, x=x, i=i, best=best):
                at = at[own[at] != i]
                d = ((stored[at] - x) ** 2).sum(axis=1)
                d, at = np.append(best[0], d), np.append(best[1], at)
                first = np.lexsort((own[at], d))[:k]
                best[0], best[1] = d[first], at[first]
                return float(best[0][-1]) if len(first) == k else np.inf

            tree.search(x @ own_projection, verify, bound, limit)
            rows += [(int(i), key, None if own[j] == _LAST else int(own[j]), float(d)) for d, j in zip(*best)]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = {"query_id": pa.int64(), "qkey": pa.string(), "vec_id": pa.int64(), "squared": pa.float64()}
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    return search


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, confidence: float = CONFIDENCE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``vectors`` found for each
    row of ``queries`` (same columns), by Euclidean distance in double precision.

    Rows of the query's own id are no candidates, all others are: repeated rows each,
    and rows without an id, whose ``vec_id`` is null. Ties go to the smaller id, null
    last; ranks count from 1; with fewer than k candidates all come. Repeated queries
    are answered once, queries without an id not. Vectors that are null, zero or hold a
    null or a non-finite component take no part, and a query's candidates have its
    length. No vectors or no queries give no rows.

    Every length of vector has regions of its own; beyond the ``FITTED_LENGTHS``
    commonest ones it is one region, searched in blocks."""
    spark, kind = vectors.sparkSession, number_type(vectors, embedding)
    dimensions = DIMENSIONS

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("v"))
        return df.where(usable(F.col("v"))).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))

    rows = kept_table(clean(vectors), "candidates")
    lengths = common_lengths(rows, "v")
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    asked = kept_table(clean(queries).where("vec_id is not null").drop("copies"), "queries")
    # Projections and boxes: bounded by FITTED_LENGTHS and MAX_REGIONS.
    fitted = {d: Regions(drawn(rows.where(F.size("v") == d), "v", n, FITTED), n, dimensions) for d, n in lengths.items()}
    shared = spark.sparkContext.broadcast(fitted)

    def regions_of(length: int) -> Regions:
        return shared.value.get(length) or Regions(np.zeros((0, length)), 0, dimensions)

    limit = chi_square_quantile(confidence, dimensions)

    def store(batches):
        for length, batch in (part for whole in batches for part in by_length(whole, "v")):
            regions, x = regions_of(length), matrix(batch.column("v"))
            packed = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
            where = regions.region(x @ regions.projection) + length * MAX_REGIONS
            yield pa.RecordBatch.from_arrays([pa.array(where), batch.column("vec_id"), packed], ["region", "vec_id", "v"])

    # Of a row that is there more often, no query takes more than k.
    repeated = rows.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))).alias("copy"))
    stored = kept_table(repeated.select("vec_id", "v").mapInArrow(store, "region bigint, vec_id bigint, v binary"), "regions")
    sizes = stored.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))

    def visits(bounded: bool):
        def seek(batches):
            for length, batch in (part for whole in batches for part in by_length(whole, "v")):
                own, x = regions_of(length), matrix(batch.column("v"))
                projected = x @ own.projection
                bounds = np.full(len(x), np.inf)
                if bounded:
                    bounds = batch.column("bound").to_numpy(zero_copy_only=False)
                    open_ = own.squared_distances(projected) <= limit * bounds[:, None]
                    open_[np.arange(len(x)), own.region(projected)] = False  # searched before
                    at, where = np.nonzero(open_)
                else:
                    at, where = np.arange(len(x)), own.region(projected)
                packed = pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())
                index = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where.astype(np.int64) + length * MAX_REGIONS), batch.column("vec_id").take(index), packed.take(index), batch.column("qkey").take(index), pa.array(bounds[at])],
                    ["region", "vec_id", "v", "qkey", "bound"],
                )

        return seek

    schema = "region bigint, vec_id bigint, v binary, qkey string, bound double"

    def searched(seeking: DataFrame) -> DataFrame:
        counts = seeking.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).cast("int").alias("parts"))
        shape = sizes.join(counts, "region")
        left = stored.join(shape, "region").select(
            "region", F.pmod(F.xxhash64("vec_id", "v", F.lit(3)), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.lit(False).alias("seeks"), "vec_id", "v", F.lit(None).cast("string").alias("qkey"), F.lit(0.0).alias("bound"),
        )
        right = seeking.join(shape, "region").select(
            "region", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("vec_id", "v", F.lit(3)), F.col("parts")).cast("int").alias("part"),
            F.lit(True).alias("seeks"), "vec_id", "v", "qkey", "bound",
        )
        return left.union(right).groupBy("region", "block", "part").applyInArrow(
            _searched(kind, k, confidence, dimensions), "query_id bigint, qkey string, vec_id bigint, squared double"
        )

    asked = asked.withColumn("qkey", F.hex(F.xxhash64("v")))
    first = kept_table(searched(asked.select("vec_id", "v", "qkey").mapInArrow(visits(False), schema)), "first-neighbours")
    ranked = Window.partitionBy("query_id", "qkey").orderBy("squared", F.asc_nulls_last("vec_id"))
    reached = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "qkey", F.col("squared").alias("bound"))
    bounded = asked.join(reached, ["vec_id", "qkey"], "left").select("vec_id", "v", "qkey", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    rest = searched(bounded.mapInArrow(visits(True), schema))
    return (
        first.union(rest)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.sqrt("squared").alias("score"))
    )


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))
