"""Centroid clustering against plain rounds over whole numbers."""

import hashlib
import math

import numpy as np

from marinelake.llm.centroids import ROUNDS, cluster_vectors, lower_bounds, nearest, distances, pivot_pairs, squared, whole

SCHEMA = "vec_id bigint, embedding array<double>, label int, v int, cluster string"


def brute(rows, k=8, rounds=ROUNDS, d=64):
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    key = [(i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept]
    centroids = [kept[n][1] for n in sorted(range(len(kept)), key=key.__getitem__)[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        placed = place()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, at) in zip(kept, placed) if at == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    placed = place()
    total = sum(x for x, _ in placed)
    fit = lambda x: x if x < 1 << 63 else None
    return sorted(
        (
            (i is None, i or 0, n, fit(x), fit(sum(y for y, m in placed if m == n)), fit(total), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
            for (i, _), (x, n) in zip(kept, placed)
        ),
        key=str,
    )


def got(df):
    return sorted(
        ((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect()),
        key=str,
    )


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(7)
    # Three tight groups, ties between centroids, a third of all rows equal.
    x = np.round(np.concatenate([rng.normal(size=(60, 64)) * 0.1 + c for c in (-1, 0, 2)]), 2).tolist()
    x += [x[0]] * 90 + [[0.0] * 64, [0.5 / 1024] * 64]
    rows = list(enumerate(x)) + [(5, x[9]), (5, x[9]), (None, x[3])]
    df = spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA)
    assert got(cluster_vectors(df)) == brute(rows)
    assert got(cluster_vectors(df.repartition(5), centroids=3, rounds=2)) == brute(rows, 3, 2)


def test_odd_rows(spark):
    one = [0.25] * 64
    rows = [
        (0, one), (0, one), (1, None), (2, []), (3, one[:63]), (4, one + [0.1]), (5, [None] + one[1:]),
        (6, [float("nan")] + one[1:]), (7, [float("-inf")] + one[1:]), (8, [-0.75] * 64), (None, [1.0] * 64), (9, [0.1] * 5000),
    ]
    df = spark.createDataFrame([(i, v, None, None, None) for i, v in rows], SCHEMA)
    assert got(cluster_vectors(df)) == brute(rows)
    assert cluster_vectors(df.limit(0)).collect() == [] and cluster_vectors(df.where("vec_id = 2")).count() == 0
    assert got(cluster_vectors(df.where("vec_id = 8"))) == brute([(8, [-0.75] * 64)])


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    for scale in (2e5, 1e12, 3e38, 1e300):
        x = (rng.normal(size=(40, 64)) * scale).clip(-1.7e308, 1.7e308).tolist()
        x += [[v / 1e6 for v in y] for y in x[:10]]
        rows = list(enumerate(x))
        df = spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA)
        assert got(cluster_vectors(df, rounds=3)) == brute(rows, rounds=3)


def test_bounds_hold_and_save_checks():
    rng = np.random.default_rng(11)
    centre = rng.integers(-900, 900, (8, 64))
    x = np.concatenate([c + rng.integers(-150, 150, (300, 64)) for c in centre])
    pairs = pivot_pairs(centre)
    to_pivots, centroids = distances(x, centre), centre + rng.integers(-20, 20, centre.shape)
    bounds = lower_bounds(to_pivots, distances(centroids, centre), pairs)
    exact = np.stack([squared(x, c) for c in centroids], axis=1)
    assert (bounds <= exact).all()
    best, distance, checked = nearest(x, to_pivots, centroids, distances(centroids, centre), pairs)
    assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert checked < 1.5 * len(x)
