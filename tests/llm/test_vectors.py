"""Links and neighbours of vectors against all pairs."""

from collections import Counter

import numpy as np
import pytest

from marinelake.llm.multi_index import near_duplicate_vectors, op2_embedding_near_dedup
from marinelake.llm.neighbours import chi_square_quantile, nearest_neighbours, op3_nearest_neighbours

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, v int"


def brute_links(ids, x, cosine=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= cosine
    np.fill_diagonal(linked, False)
    own = np.arange(len(ids))
    while True:
        new = np.minimum(own, np.where(linked, own[None, :], len(ids)).min(axis=1))
        if (new == own).all():
            break
        own = new
    least = {c: min(i for i, o in zip(ids, own) if o == c) for c in set(own)}
    return linked.sum(axis=1), [least[c] for c in own]


@pytest.fixture(scope="module")
def clustered(spark):
    """Random vectors, pairs near the threshold, one large group of near copies and exact copies."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(500, 16))
    near = base[:150] + rng.normal(size=(150, 16)) * 0.25
    group = base[200] + rng.normal(size=(300, 16)) * 0.05
    x = np.concatenate([base, near, group, base[300:310], base[300:305]]).astype(np.float32)
    ids = rng.permutation(len(x)) * 2
    rows = [(int(i), v.tolist(), None, "x", 1) for i, v in zip(ids, x)]
    return ids, x.astype(float), spark.createDataFrame(rows, SCHEMA)


def test_links_against_all_pairs(clustered):
    ids, x, df = clustered
    n, component = brute_links(ids, x)
    got = {r["vec_id"]: r for r in near_duplicate_vectors(df).collect()}
    assert len(got) == len(ids)
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= n).all() and found.sum() >= 0.97 * n.sum()
    same = [got[i]["component_id"] == c for i, c in zip(ids, component)]
    assert np.mean(same) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_links_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = [r["vec_id"] for r in df], np.array([r["embedding"] for r in df], float)
    n, component = brute_links(ids, x)
    got = {r["vec_id"]: r for r in op2_embedding_near_dedup(spark, SF).collect()}
    assert [got[i]["n_links"] for i in ids] == n.tolist() and [got[i]["component_id"] for i in ids] == component


def brute_neighbours(ids, x, asked, k=10):
    out = {}
    for q in asked:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(axis=1))
        out[q] = sorted((float(s), i) for s, i in zip(d, ids) if i != q)[:k]
    return out


def test_neighbours_against_all_pairs(spark, clustered):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.collect()
    ids, x, df = clustered
    cases = [
        ([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float), op3_nearest_neighbours(spark, SF), 100),
        (ids.tolist(), x, nearest_neighbours(df, df.where("vec_id % 20 = 0")), 20),
    ]
    for names, values, result, step in cases:
        expected = brute_neighbours(names, values, [i for i in names if i % step == 0])
        got = {}
        for r in result.collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
        assert set(got) == set(expected)
        hits = 0
        for q, own in got.items():
            own.sort()
            assert [r for r, _, _ in own] == list(range(1, 11)) and [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
            for _, s, i in own:
                assert s == pytest.approx(float(np.linalg.norm(values[names.index(i)] - values[names.index(q)])), abs=1e-12)
            hits += len({i for _, _, i in own} & {i for _, i in expected[q]})
        assert hits >= 0.95 * 10 * len(expected)


ODD = [
    (0, [1.0, 0.0], 1, "a", 1),
    (1, [2.0, 0.1], None, None, None),
    (1, [2.0, 0.1], None, None, None),
    (2, None, 1, "a", 1),
    (3, [0.0, 0.0], 1, "a", 1),
    (4, [float("nan"), 1.0], 1, "a", 1),
    (5, [None, 1.0], 1, "a", 1),
    (6, [], 1, "a", 1),
    (7, [1.0, 0.0, 0.0], 1, "a", 1),
    (None, [1.0, 0.0], 1, "a", 1),
    (100, [1.0, 0.0], 1, "a", 1),
    (8, [float("inf"), 1.0], 1, "a", 1),
    (9, [-1.0, 0.0], 1, "a", 1),
    (200, [0.0, 0.0, 1.0], 1, "a", 1),
    (201, [0.0, 0.1, 2.0], 1, "a", 1),
    (300, [-3.0], 1, "a", 1),
    (301, [-2.0], 1, "a", 1),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(df).collect())
    alone = [(False, i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 9)]
    others = [(False, 200, 1, 200, True), (False, 201, 1, 200, False), (False, 300, 1, 300, True), (False, 301, 1, 300, False)]
    assert got == sorted([(False, 0, 4, 0, True), *[(False, 1, 4, 0, False)] * 2, (False, 100, 4, 0, False), (True, 0, 4, 0, False), *alone, *others])
    rows = nearest_neighbours(df, df.where("vec_id % 100 = 0"), 5).collect()
    found = {q: [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 100, 200, 300)}
    assert found == {0: [100, None, 1, 1, 9], 100: [0, None, 1, 1, 9], 200: [201, 7], 300: [301]} and len(rows) == 13
    none = df.limit(0)
    assert near_duplicate_vectors(none).count() == 0 and nearest_neighbours(none, none).count() == 0
    assert nearest_neighbours(df, none).count() == 0 and near_duplicate_vectors(df.where("vec_id = 2")).count() == 1


def test_lengths_beyond_the_fitted_ones(spark, clustered, monkeypatch):
    """Two lengths in one table, of which one index is fitted: the same links and neighbours as apart."""
    monkeypatch.setattr("marinelake.llm.vectors.FITTED_LENGTHS", 1)
    ids, x, df = clustered
    short = df.selectExpr("vec_id + 1 AS vec_id", "slice(embedding, 1, 12) AS embedding").where("vec_id < 800")
    both = df.select("vec_id", "embedding").union(short)
    rows = {r["vec_id"]: r for r in near_duplicate_vectors(both).collect()}
    own = {i + 1: v[:12] for i, v in zip(ids.tolist(), x) if i + 1 < 800}
    n, component = brute_links(list(own), np.array(list(own.values())))
    assert [rows[i]["n_links"] for i in own] == n.tolist() and [rows[i]["component_id"] for i in own] == component
    expected = brute_neighbours(list(own), np.array(list(own.values())), [i for i in own if i % 25 == 0])
    got = {}
    for r in sorted(nearest_neighbours(both, short.where("vec_id % 25 = 0")).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(expected)
    assert sum(len(set(got[q]) & {i for _, i in expected[q]}) for q in expected) >= 9.5 * len(expected)


def test_quantile():
    assert chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_a_pair_found_from_one_side_counts_for_both(spark, monkeypatch):
    from marinelake.llm.multi_index import MultiIndex

    # Few visits: many vectors seek where their partner is, and are not sought there.
    monkeypatch.setattr(MultiIndex, "_calibrated", lambda *_: 2)
    rng = np.random.default_rng(5)
    one = rng.normal(size=(1500, 16))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    away = rng.normal(size=one.shape)
    away -= (away * one).sum(axis=1, keepdims=True) * one
    two = 0.92 * one + np.sqrt(1 - 0.92**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    x = np.concatenate([one, two])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    rows = near_duplicate_vectors(df).collect()
    sizes = Counter(r["component_id"] for r in rows)
    assert any(n > 1 for n in sizes.values())
    assert all((r["n_links"] > 0) == (sizes[r["component_id"]] > 1) for r in rows)
    assert sum(r["n_links"] for r in rows) % 2 == 0
