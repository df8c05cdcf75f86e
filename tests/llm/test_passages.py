"""Repeated passages against a scan over all word runs of all documents."""

import re

import numpy as np
import pyarrow as pa
import pytest

from marinelake.llm import passages
from marinelake.llm.passages import compact_windows, cut_passages, find_passages, op4_substring_dedup, shared_runs
from marinelake.llm.words import placed_words

SF = "/root/testdata/sf0.01"


def words(text):
    return [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]


def exact_repeats(docs, n=50):
    """Word positions of each document that lie in a run of n words of an earlier one."""
    seen, out = {}, {}
    for i, text in sorted(docs.items()):
        w = words(text)
        runs = [tuple(x[2] for x in w[k : k + n]) for k in range(len(w) - n + 1)]
        for k, run in enumerate(runs):
            if run in seen:
                out.setdefault(i, set()).update(range(k, k + n))
        for run in runs:
            seen.setdefault(run, i)
    return out


def test_windows_are_the_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(1)
    owner = np.repeat([0, 1, 2], [70, 3, 60])
    v = rng.integers(1, 1 << 62, len(owner)).astype(np.uint64)
    v[100:110] = v[100]
    expected = []
    for c in range(len(v)):
        a = b = c
        while a and owner[a - 1] == owner[c] and v[a - 1] >= v[c]:
            a -= 1
        while b + 1 < len(v) and owner[b + 1] == owner[c] and v[b + 1] >= v[c]:
            b += 1
        if b - a + 1 >= 12:
            expected.append(c)
    assert compact_windows(v, owner, 12).tolist() == expected


def test_words_have_places():
    texts = ["", "Ab c dé, «x»　y", "’q 日本 z"]
    hashes, starts, ends, offsets = placed_words(pa.array(texts))
    assert np.diff(offsets).tolist() == [0, 5, 3]
    for i, t in enumerate(texts):
        got = [t.encode()[a:b].decode().lower() for a, b in zip(starts[offsets[i] : offsets[i + 1]], ends[offsets[i] : offsets[i + 1]])]
        assert got == [x[2] for x in words(t)]


def test_runs_allow_edits():
    rng = np.random.default_rng(3)
    a, other = rng.integers(0, 1 << 60, (2, 300)).astype(np.uint64)
    b = np.concatenate([other[:100], a[50:90], other[100:105], a[94:180], other[200:]])
    assert shared_runs(a, b, 46, 0.8) == [(50, 180)]
    assert shared_runs(a, other, 46, 0.8) == [] and shared_runs(a, a[10:50], 46, 0.8) == []


def test_all_exact_repeats_of_the_table_are_found(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = exact_repeats(docs)
    found = {}
    for r in op4_substring_dedup(spark, SF).collect():
        assert r["first_doc_id"] < r["doc_id"] and r["n_words"] >= 50
        found.setdefault(r["doc_id"], set()).update(k for k, (a, b, _) in enumerate(words(docs[r["doc_id"]])) if r["start"] <= a and b <= r["end"])
    assert expected and all(expected[i] <= found.get(i, set()) for i in expected)
    # What else is found is near to a repeat: most of its words are exact ones, or it is a similar passage.
    assert len(found) <= 1.3 * len(expected) + 3


def test_first_document_keeps_the_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    edited = " ".join(f"p{i}" if i != 30 else "changed" for i in range(60))
    own = lambda k: " ".join(f"d{k}w{i}" for i in range(80))
    rows = [(1, f"{own(1)}. {passage}. {own(11)}"), (2, f"{own(2)} {passage}"), (3, f"{edited}! {own(3)}"), (4, own(4)), (5, f"{own(2)} {passage}"), (None, f"é {passage} {own(5)}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'x' AS ranges", "1 AS `_key`")
    left = cut_passages(df).collect()
    assert len(left) == 6 and left[0].asDict().keys() == {"doc_id", "text", "ranges", "_key"}
    texts = {r["doc_id"]: r["text"] for r in left}
    assert texts[1] == rows[0][1] and texts[4] == rows[3][1]
    assert texts[2].strip() == own(2) and texts[3].strip(" !") == own(3) and texts[5] == ""
    assert texts[None] == f"é  {own(5)}"
    spans = {(r["doc_id"], r["first_doc_id"]) for r in find_passages(df).collect()}
    assert spans == {(2, 1), (3, 1), (5, 2), (None, 1)}


def test_odd_rows(odd, empty):
    assert cut_passages(odd).columns == odd.columns
    assert sorted(map(str, cut_passages(odd).collect())) == sorted(map(str, odd.collect()))
    assert find_passages(odd).count() == 0 and find_passages(empty).count() == 0 and cut_passages(empty).count() == 0


def test_a_partner_in_the_middle_of_a_signature_is_found(spark):
    """Variants are similar to the base, which is neither the first nor the one before, and not to each other."""
    base = [f"b{i}" for i in range(55)]
    variant = lambda k: " ".join(f"changed{k}" if i == 8 + k % 39 else w for i, w in enumerate(base))
    rows = [(k, variant(k) if k != 20 else " ".join(base)) for k in range(39)]
    found = {(r["doc_id"], r["first_doc_id"]) for r in find_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    later = {k for k, first in found if first == 20}
    assert later <= set(range(21, 39)) and len(later) >= 16


def similar_windows(one, other, n=50, size=5, similarity=0.8):
    """Word positions of ``one`` in a run of n words that is similar to a run of ``other``, by trying all of them."""
    shingled = lambda w: [{tuple(w[k + m : k + m + size]) for m in range(n - size + 1)} for k in range(len(w) - n + 1)]
    theirs, out = shingled(other), set()
    for k, own in enumerate(shingled(one)):
        if any(len(own & b) >= similarity * len(own | b) for b in theirs):
            out.update(range(k, k + n))
    return out


@pytest.mark.parametrize("length, edits", [(50, [0]), (50, [1]), (50, [4]), (50, [45]), (50, [48]), (50, [25]), (52, [1, 50]), (70, [20, 50]), (90, [40])])
def test_passages_with_changed_words_are_found(spark, length, edits):
    rng = np.random.default_rng(length + sum(edits))
    some = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    rows, pairs = [], 60
    for k in range(pairs):
        passage = some(length)
        changed = [f"changed{k}" if i in edits else w for i, w in enumerate(passage)]
        rows += [(2 * k, some(90) + passage + some(70)), (2 * k + 1, some(60) + changed + some(100))]
    texts = dict(rows)
    found = find_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect()
    assert all((r["doc_id"], r["first_doc_id"]) in {(2 * k + 1, 2 * k) for k in range(pairs)} and r["n_words"] >= 50 for r in found)
    assert len({r["doc_id"] for r in found}) >= (0.8 if edits == [25] else 0.95) * pairs
    for r in found[:10]:
        own = similar_windows(texts[r["doc_id"]], texts[r["first_doc_id"]])
        start = len(" ".join(texts[r["doc_id"]])[: r["start"]].split())
        covered = set(range(start, start + r["n_words"]))
        # No more than a wholly similar longer run's ends, and nearly all that any window holds.
        assert len(covered & own) >= 0.8 * len(own) and len(covered - own) <= 10


def test_unlike_passages_are_left(spark):
    rng = np.random.default_rng(9)
    some = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    rows = []
    for k in range(60):
        passage = some(44 if k % 2 else 50)  # too short, or changed in two places
        changed = passage if k % 2 else [w if i not in (15, 33) else "x" for i, w in enumerate(passage)]
        rows += [(2 * k, some(50) + passage + some(50)), (2 * k + 1, some(50) + changed + some(50))]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    assert find_passages(df).count() == 0


def test_partners_equal_all_pairs_with_few_full_comparisons(monkeypatch):
    """Runs that share many shingles but no passage are told apart before they are aligned."""
    from marinelake.llm import passages

    rng = np.random.default_rng(4)
    common = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    runs = []
    for i in range(120):
        x = rng.integers(1, 1 << 62, 185).astype(np.uint64)
        kind = i % 6
        if kind < 3:  # blocks too short for a passage, far apart
            x[20:50], x[120:150] = common[:30], common[100:130]
        elif kind == 3:  # a passage, some of it changed
            x[60:120] = np.where(rng.random(60) < rng.uniform(0, 0.4), x[60:120], common[200:260])
        elif kind == 4:  # repeats inside
            x[0:60], x[90:150] = np.tile(common[300:310], 6), np.tile(common[300:305], 12)
        else:
            x = x[: rng.integers(5, 80)]
            x[:40] = common[200:240][: len(x)] if len(x) >= 40 else x[:40]
        runs.append(x)
    calls = []
    whole = passages.shared_runs

    def counted(*args):
        calls.append(1)
        return whole(*args)

    def earlier(i):
        return np.arange(len(runs)) < i

    expected = {i for i in range(len(runs)) for j in range(i) if whole(runs[i], runs[j], 46, 0.8)}
    monkeypatch.setattr(passages, "shared_runs", counted)
    found = passages.near_partners(runs, runs, earlier, 46, 0.8)
    assert {i for i, _ in found} == expected and len(expected) > 10
    assert all(j < i and whole(runs[i], runs[j], 46, 0.8) for i, j in found)
    assert len(calls) < 120 * 119 / 2 / 4


def test_places_and_distinct_pairs_agree_with_unique():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 300):
        a, b = rng.integers(0, 20, (2, n))
        pairs, first = np.unique(np.stack([a, b]), axis=1, return_index=True)
        at = passages._distinct_pairs(a, b)
        assert at.tolist() == first.tolist() and np.stack([a[at], b[at]]).tolist() == pairs.tolist()
        values, first, before = passages.places_of(a)
        assert [x.tolist() for x in (values, first)] == [x.tolist() for x in np.unique(a, return_index=True)]
        for lo, hi in ((0, n), (n // 3, n), (n // 2, n // 2)):
            assert passages._n_distinct(before, lo, hi) == len(set(a[lo:hi].tolist()))
        if n:
            assert passages._median(a) == np.median(a)


def test_runs_are_found_without_sorting_each_one(monkeypatch):
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 62, 600).astype(np.uint64)
    b = a.copy()
    b[::90] = 1
    b[300:400] = rng.integers(0, 1 << 62, 100)
    wanted = passages.shared_runs(a, b, 46, 0.8)
    assert wanted
    places = passages.places_of(a), passages.places_of(b)
    monkeypatch.setattr(np, "unique", None)
    assert passages.shared_runs(a, b, 46, 0.8, places=places) == wanted
