"""Words, shingles, components and near-duplicates against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marinelake.llm import minhash
from marinelake.llm.components import components
from marinelake.llm.minhash import document_frequencies, drop_near_duplicates, near_duplicates, op6_minhash_near_dedup
from marinelake.llm.words import shingles, word_hashes

SF = "/root/testdata/sf0.01"


def plain_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_shingles(text):
    w = plain_words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_hashes_agree_with_words():
    texts = ["a b c a b c", "", "b", " c", "É é!! x2", "a", "b" * 70, "x y z"]
    hashes, offsets = word_hashes(pa.array(texts))
    assert np.diff(offsets).tolist() == [len(plain_words(t)) for t in texts]
    flat = [w for t in texts for w in plain_words(t)]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    values, ends = shingles(hashes, offsets, 2)
    pairs = [p for t in texts for w in [plain_words(t)] for p in ([tuple(w[i : i + 2]) for i in range(max(len(w) - 1, 1 if w else 0))])]
    assert len(pairs) == len(values) == ends[-1]
    assert len(set(zip(pairs, values.tolist()))) == len(set(pairs)) == len(set(values.tolist()))


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_components(spark, kind):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint").selectExpr(f"lpad(a, 4, '0') AS a", "lpad(b, 4, '0') AS b")
    df = df if kind == "string" else df.selectExpr("cast(a AS bigint) AS a", "cast(b AS bigint) AS b")
    got = {int(r["node"]): int(r["component"]) for r in components(df.repartition(5)).collect()}
    links = [(a, b) for a, b in links if a != b]
    assert got == classes({n for e in links for n in e}, links)
    assert components(df.limit(0)).count() == 0


def brute(spark, docs):
    """Classes from all pairs of texts, by the weights that the operator states."""
    frequencies, n = document_frequencies(docs.select("text"))
    sampler = minhash.Sampler(frequencies, n)
    texts = sorted({r["text"] for r in docs.collect() if plain_words(r["text"])})
    sets = []
    for t in texts:
        values, counts, _ = minhash._sets(pa.array([t]), 5)
        sets.append(dict(zip(values.tolist(), sampler.weights(values, counts).tolist())))
    holders = {}
    for i, s in enumerate(sets):
        for v in s:
            holders.setdefault(v, []).append(i)
    near = {(a, b) for own in holders.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    links = []
    for a, b in near:
        keys = set(sets[a]) | set(sets[b])
        if sum(min(sets[a].get(k, 0), sets[b].get(k, 0)) for k in keys) >= 0.8 * sum(max(sets[a].get(k, 0), sets[b].get(k, 0)) for k in keys):
            links.append((texts[a], texts[b]))
    return classes(texts, links)


def test_groups_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute(spark, docs)
    rows = docs.select("doc_id", "text").collect()
    ids = {}
    for r in rows:
        c = expected.get(r["text"], r["doc_id"])
        ids[c] = min(ids.get(c, r["doc_id"]), r["doc_id"])
    got = {r["doc_id"]: (r["group_id"], r["kept"]) for r in op6_minhash_near_dedup(spark, SF).collect()}
    want = {r["doc_id"]: ids[expected.get(r["text"], r["doc_id"])] for r in rows}
    assert {i: g for i, (g, _) in got.items()} == want
    assert all(kept == (i == g) for i, (g, kept) in got.items())
    assert len(set(want.values())) < len(rows)


def test_a_chain_and_a_large_group(spark):
    """A chain whose ends are not similar, and a group of near copies, stay whole."""
    words = [f"w{i}" for i in range(300)]
    chain = []
    for i in range(8):
        chain.append((i, " ".join(words[:200] if not i else [*chain[-1][1].split()[4:], *(f"n{i}x{j}" for j in range(4))])))
    group = [(100 + i, " ".join([*(f"g{j}" for j in range(150)), f"own{i}"])) for i in range(120)]
    other = [(1000 + i, " ".join(f"z{i}y{j}" for j in range(50))) for i in range(20)]
    docs = spark.createDataFrame(chain + group + other, "doc_id bigint, text string")
    got = {r["doc_id"]: r["group_id"] for r in near_duplicates(docs).collect()}
    assert {got[i] for i, _ in chain} == {0} and {got[i] for i, _ in group} == {100}
    assert all(got[i] == i for i, _ in other)


def test_odd_rows(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    # Wordless rows are all kept; equal texts form one group of which all equal rows are marked.
    assert Counter((r["doc_id"], r["group_id"], r["kept"]) for r in rows)[(1, 1, True)] == 2
    assert all(r["kept"] for r in rows)
    left = drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 2, 3, None, None, 4, 5, 6, 7])
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_odd_sketches_lose_no_link():
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in rng.integers(0, 500, 400)]
    texts = [" ".join(f"x{i}y{j}" if rng.random() < share else w for j, w in enumerate(base)) for i, share in enumerate(rng.uniform(0, 0.2, 60))]
    texts += ["", "a", "a a a a a a a a a b", "a " * 3000, "a " * 3100]
    values, counts, offsets = minhash._sets(pa.array(texts), 5)
    frequencies = rng.integers(1, 60, 1 << minhash.COUNTERS_LOG2)
    sampler = minhash.Sampler(frequencies, 60)
    odd = sampler.odd(values, counts, offsets).view(np.uint64)
    weights = sampler.weights(values, counts)
    total = [weights[a:b].sum() for a, b in zip(offsets, offsets[1:])]
    i, j = (x.ravel() for x in np.indices((len(texts), len(texts))))
    found = minhash.weighted_jaccards((values, weights, offsets), (values, weights, offsets), i, j)
    near = 0
    for a, b, s in zip(i, j, found):
        differ = int(np.bitwise_count(odd[a] ^ odd[b]).sum()) * sampler.counted
        assert differ <= (total[a] + total[b]) * (1 - s) / (1 + s) + 1e-6
        near += s >= 0.8
    assert near > len(texts)


def test_copies_below_the_threshold_are_not_compared(spark, monkeypatch):
    """Of a group of copies that are mostly at 0.6 to 0.75 most pairs are settled without their texts."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(f"x{i}y{j}" if rng.random() < 0.02 else w for j, w in enumerate(base))) for i in range(120)]
    compared = []
    verified = minhash._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(minhash, "_verified", counted)
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    expected = brute(spark, docs)
    got = {r["doc_id"]: r["group_id"] for r in near_duplicates(docs).collect()}
    ids = {}
    for r in docs.collect():
        ids.setdefault(expected[r["text"]], []).append(r["doc_id"])
    assert got == {i: min(own) for own in ids.values() for i in own}
    assert sum(compared) < 120 * 119 / 2 / 4


@pytest.mark.parametrize("most", [0, 60, 100_000])
def test_few_links_need_no_rounds(spark, monkeypatch, most):
    from marinelake.llm import components as module

    monkeypatch.setattr(module, "LINKS_A_TASK", most)
    written = []
    whole = module.kept_table
    monkeypatch.setattr(module, "kept_table", lambda df, name, **options: written.append(name) or whole(df, name, **options))
    rng = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 340)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(7)).collect()}
    assert got == classes({n for e in links for n in e if e[0] != e[1]}, links)
    assert most < 1000 or len(written) == 2


def test_a_small_table_is_written_by_few_tasks(spark, tmp_path):
    from marinelake.llm.common import kept_table

    few = kept_table(spark.range(900).repartition(150, "id"), "few", rows=900)
    assert few.count() == 900 and len(few.inputFiles()) <= max(spark.sparkContext.defaultParallelism, 1)
