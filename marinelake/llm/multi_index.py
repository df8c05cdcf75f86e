"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; the product of both is a grid of
cells. A vector's nearest cells are visited in the order of the summed distances of
its halves, as many as the target recall needs, and what lies there is verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import kept_table
from marinelake.llm.components import components
from marinelake.llm.registry import query, table
from marinelake.llm.vectors import by_length, common_lengths, drawn, matrix, number_type, unpacked, usable

COSINE = 0.9
#: Vectors that the codebooks are fitted on, at most; every vector is indexed.
FITTED = 20_000
#: Vectors of a cell that the size of the codebooks aims at, and the largest codebook.
PER_CELL = 12
MAX_CODEWORDS = 1024
#: Share of calibration pairs, each just at the threshold, whose cell must be visited.
TARGET_RECALL = 0.98
#: Neighbouring codewords of the second half whose cells are verified together.
WIDTH = 8
#: Rows of either side in one block: larger groups are cut into blocks.
BLOCK = 2048


def _kmeans(x: np.ndarray, k: int, rng) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(12):
        own = _distances(x, centres).argmin(axis=1)
        sums, n = np.zeros_like(centres), np.bincount(own, minlength=k)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    axis = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0]
    return centres[np.argsort(centres @ axis, kind="stable")]  # near codewords get near numbers


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


class OneCell:
    """The index of a length of vector that has no codebooks: all lie in one cell."""

    visits = 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        return np.zeros(len(unit), np.int64)

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        return np.zeros((len(unit), 1), np.int64)


class MultiIndex:
    """Codebooks of both halves and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, total: int, cosine: float):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        rng = np.random.default_rng(7)
        self.half = unit.shape[1] // 2
        wanted = 1 << max(1, int(np.ceil(np.log2(max(total, 1) / PER_CELL) / 2)))
        k = min(wanted, MAX_CODEWORDS, max(1, len(unit) // 4))
        self.books = [_kmeans(part, k, rng) for part in (unit[:, : self.half], unit[:, self.half :])]
        self.visits = self._calibrated(unit[rng.permutation(len(unit))[:2000]], cosine, rng)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        i, j = (_distances(x, b).argmin(axis=1) for x, b in zip((unit[:, : self.half], unit[:, self.half :]), self.books))
        return i * len(self.books[1]) + j

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The n nearest cells of each vector, nearest first. A pair of ranks (a, b) can
        be among the first n sums only if (a + 1)(b + 1) <= n."""
        k = len(self.books[0])
        n = min(n, k * k)
        ranks = np.array([(a, b) for a in range(min(k, n)) for b in range(min(k, n // (a + 1)))])
        far = [_distances(x, b) for x, b in zip((unit[:, : self.half], unit[:, self.half :]), self.books)]
        order = [np.argsort(d, axis=1, kind="stable")[:, :n] for d in far]
        close = [np.take_along_axis(d, o, axis=1) for d, o in zip(far, order)]
        sums = close[0][:, ranks[:, 0]] + close[1][:, ranks[:, 1]]
        first = np.argsort(sums, axis=1, kind="stable")[:, :n]
        a, b = ranks[first, 0], ranks[first, 1]
        return np.take_along_axis(order[0], a, axis=1) * k + np.take_along_axis(order[1], b, axis=1)

    def _calibrated(self, unit: np.ndarray, cosine: float, rng) -> int:
        """Cells to visit so that a partner just at the threshold is found with the target recall."""
        away = rng.normal(size=unit.shape)
        away -= (away * unit).sum(axis=1, keepdims=True) * unit
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
        partner = self.cells(cosine * unit + np.sqrt(1 - cosine**2) * away)
        whole, n = len(self.books[0]) ** 2, 1
        while n < whole and (self.nearest(unit, n) == partner[:, None]).any(axis=1).mean() < TARGET_RECALL:
            n *= 2
        return min(n, whole)


def _trees(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest rank that each row and column of a link matrix reaches; ``left``
    and ``right`` are the ranks of rows and columns, equal for the same vector."""
    a, b = left.copy(), right.copy()
    none = np.iinfo(np.int64).max
    while True:
        na = np.minimum(a, np.where(linked, b[None, :], none).min(axis=1, initial=none))
        nb = np.minimum(b, np.where(linked, na[:, None], none).min(axis=0, initial=none))
        if (na == a).all() and (nb == b).all():
            return a, b
        a, b = na, nb


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Links join rows whose cosine, in double precision, is at least ``cosine``; equal
    vectors are linked and are searched for once, their links count for each row.
    ``component_id`` is the smallest id that links reach (null only if no row of the
    component has one), ``kept`` marks the rows that have it. A vector that is null,
    zero, or holds a null or a non-finite component links with nothing, and vectors of
    different lengths do not link. Repeated rows are rows. No rows, no result.

    Every length of vector has an index of its own; beyond the ``FITTED_LENGTHS``
    commonest ones it is a single cell, compared in blocks."""
    kind = number_type(vectors, embedding)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("v"))
    good = usable(F.col("v"))
    key = F.concat(F.hex(F.xxhash64("v")), F.lit("-"), F.hex(F.xxhash64(F.reverse("v"), F.lit(5))))
    keyed = rows.withColumn("key", F.when(good, key))
    distinct = kept_table(keyed.where("key is not null").groupBy("key").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies")), "vectors")
    lengths = common_lengths(distinct, "v")
    alone = keyed.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not lengths:
        return alone
    spark = vectors.sparkSession
    # One component has no halves. Codebooks and one number each: bounded by FITTED_LENGTHS and MAX_CODEWORDS.
    indexes = {d: MultiIndex(drawn(distinct.where(F.size("v") == d), "v", n, FITTED), n, cosine) for d, n in lengths.items() if d > 1}
    shared = spark.sparkContext.broadcast(indexes)

    def visit(batches):
        for length, batch in (part for whole in batches for part in by_length(whole, "v")):
            index, base = shared.value.get(length, OneCell()), length * MAX_CODEWORDS**2
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                x = matrix(part.column("v"))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                packed = [r.tobytes() for r in x.astype(kind)]
                keys, copies = part.column("key"), part.column("copies")
                # Each group of cells once per vector; the own one first, as an indexed row.
                groups = [np.unique(c) + base for c in index.nearest(unit, index.visits) // WIDTH]
                n = np.fromiter(map(len, groups), np.int64, len(groups))
                at = pa.array(np.repeat(np.arange(len(n)), n))
                visited, home = np.concatenate(groups), index.cells(unit) // WIDTH + base
                # A seeking row tells where it is stored, a stored one where it seeks itself.
                homes = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32)), pa.array(home.astype(np.int64)))
                visits = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(visited.astype(np.int64)))
                sides = [(np.ones(len(at), bool), visited, at, homes), (np.zeros(len(n), bool), home, pa.array(np.arange(len(n))), visits)]
                for seeks, cells, own, groups_of in sides:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells.astype(np.int64)), pa.array(seeks), keys.take(own), copies.take(own), pa.array(packed, pa.binary()).take(own), groups_of.take(own)],
                        ["cells", "seeks", "key", "copies", "v", "groups"],
                    )

    placed = kept_table(distinct.mapInArrow(visit, "cells bigint, seeks boolean, key string, copies bigint, v binary, groups array<bigint>"), "visits")
    sizes = placed.groupBy("cells").agg(
        F.ceil(F.sum(F.when(F.col("seeks"), 0).otherwise(1)) / BLOCK).alias("stored"), F.ceil(F.sum(F.when(F.col("seeks"), 1).otherwise(0)) / BLOCK).alias("seeking")
    )
    cut = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    sized = placed.join(sizes.where("stored > 0 and seeking > 0"), "cells")
    blocks = (
        sized.where("seeks").withColumn("q", cut("seeking")).withColumn("s", every("stored"))
        .unionByName(sized.where("not seeks").withColumn("s", cut("stored")).withColumn("q", every("seeking")))
        .select("cells", "s", "q", "seeks", "key", "copies", "v", "groups")
    )

    def verify(block):
        unit = unpacked(block.column("v").to_pylist(), kind)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        keys = np.array(block.column("key").to_pylist(), object)
        seeks = block.column("seeks").to_numpy()
        ranks = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        linked = (unit[seeks] @ unit[~seeks].T >= cosine) & (ranks[seeks][:, None] != ranks[~seeks][None, :])
        copies = block.column("copies").to_numpy()
        n = linked @ copies[~seeks]
        # A stored row that does not seek where the other is stored will not find the pair itself.
        lists = block.column("groups").combine_chunks()
        home, which = np.unique(lists.filter(pa.array(seeks)).flatten().to_numpy(), return_inverse=True)
        visits = lists.filter(pa.array(~seeks))
        group = visits.flatten().to_numpy()
        owner = np.repeat(np.arange(len(visits)), visits.value_lengths().to_numpy())
        at = np.minimum(np.searchsorted(home, group), len(home) - 1)
        unseen = np.ones((len(home), len(visits)), bool)
        unseen[at[home[at] == group], owner[home[at] == group]] = False
        back = copies[seeks] @ (linked & unseen[which])
        a, b = _trees(linked, ranks[seeks], ranks[~seeks])
        names = np.empty(ranks.max() + 1, object)
        names[ranks] = keys
        rows, columns = np.flatnonzero(n > 0), np.flatnonzero(linked.any(axis=0))
        return pa.table(
            {
                "key": pa.array([*keys[seeks][rows], *keys[~seeks][columns]], pa.string()),
                "root": pa.array([*names[a[rows]], *names[b[columns]]], pa.string()),
                "n": pa.array(np.append(n[rows], back[columns])),
            }
        )

    found = kept_table(blocks.groupBy("cells", "s", "q").applyInArrow(verify, "key string, root string, n bigint"), "vector-links")
    linked = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    classes = (
        distinct.select("key", "copies")
        .join(linked.withColumnRenamed("node", "key"), "key", "left")
        .join(counts, "key", "left")
        .select("key", F.coalesce("component", "key").alias("class"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = kept_table(keyed.where("key is not null").select("vec_id", "key").join(classes, "key"), "named-vectors")
    least = named.groupBy("class").agg(F.min("vec_id").alias("component_id"))
    joined = named.join(least, "class").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return joined.union(keyed.where("key is null").select("vec_id", F.lit(0).cast("bigint"), "vec_id", F.lit(True)))


@query("op2_embedding_near_dedup")
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
