"""The prefix trie against dictionaries of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

import marinelake.llm.prefixes as prefixes
from marinelake.llm.prefixes import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, x1 string"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}
    through, ending = defaultdict(list), defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
        ending[seq].append(c)
        for d in range(len(seq) + 1):
            through[seq[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in through:
        if node:
            children[node[:-1]] += 1
    for node, members in through.items():
        bytes_ = len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members) - 1) * bytes_
    return sorted(
        (
            (min(m), len(p), min(through[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ending[p]))).encode()).hexdigest())
            for p, m in through.items()
        ),
        key=str,
    )


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in prefix_trie(df.repartition(3)).collect()), key=str)


def conversation(c, *texts):
    return [(c, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]


def varied():
    rows = []
    for c in range(60):
        rows += conversation(c, "hello", f"answer {c % 3}", "ça va", *[f"more {c % 7}"] * (c % 4))
    for c in range(100, 160):  # one text, often
        rows += conversation(c, "hello", "the same", "end", "and", "so", "on", "and", "on", "for", "ever")
    for c in range(205, 400, 7):  # leaders are absent
        rows += conversation(c, *["a", "b", "c", "d", "e"][: c % 6])
    return rows


@pytest.mark.parametrize("bits", [10, 1])
def test_against_dictionaries(spark, monkeypatch, bits):
    # With blocks of two turns or members, everything crosses blocks.
    monkeypatch.setattr(prefixes, "BLOCK_BITS", bits)
    rows = varied() + conversation(1000, *[f"turn {i % 5}" for i in range(40)]) + conversation(1003, *[f"turn {i % 5}" for i in range(33)])
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (1, None, None, None), (1, 0, "user", ""), (2, 0, "", "user"), (2, 0, "user", ""), (2, 0, "user", ""),
        (3, -5, "a", "b"), (3, None, "a", "b"), (3, 7, "ab", ""), (4, 0, "a\x001", "b"), (5, 0, "a", "x" * 200_000), (5, 1, "é", "日本"),
        (6, 0, "a", "x" * 200_000), (-7, 0, "u", "negative"), (-5, 0, "u", "leader"), (-5, 1, "u", "of negatives"), (2**53 * 5, 0, "u", "large"),
    ]
    # Spark's remainder has the sign of the id, Python's has not.
    plain = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(spark, plain) == brute(plain)
    assert len(got(spark, rows)) >= len(brute(plain))
    assert got(spark, [(None, 0, "user", "no id")]) == [] and got(spark, rows[:0]) == []


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(6, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = conversation(c, "one", "two")
    assert got(spark, rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == brute(rows)
