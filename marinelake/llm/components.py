"""Connected components of links by alternating stars, all in joins and aggregates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marinelake.llm.common import drop_kept, kept_table


#: So many links one task contracts at once; more are contracted in rounds of joins.
LINKS_A_TASK = 100_000


def forest(batches, kind, roots=False):
    """Links of a task contracted to stars around the smallest node of each tree;
    ``roots``: with a link of each such node to itself."""
    parent: dict = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if roots or root(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of a link (``a, b``, of one type, any order,
    repeats and loops allowed): the smallest node that links reach. No links, no rows.

    Each task first contracts its own links; then large and small stars alternate
    until nothing changes, each round written to the shared folder in place of the one
    before; the last table stays, and ``drop_kept`` of the result deletes it. As soon as
    at most ``LINKS_A_TASK`` are left, one task contracts them: no round is needed."""
    text = links.schema["a"].dataType.simpleString()
    kind = pa.string() if text == "string" else pa.int64()
    # a is the larger node, b the smaller.
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = kept_table(links.mapInArrow(lambda batches: forest(batches, kind), links.schema), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] <= LINKS_A_TASK:
            stars = kept_table(links.coalesce(1).mapInArrow(lambda batches: forest(batches, kind, True), links.schema), "links")
            drop_kept(links)
            found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
            found.kept_path = stars.kept_path
            return found
        if tuple(state) == seen:
            break
        seen = tuple(state)
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
        before, links = links, kept_table(small.select("s.a", "s.b").where("a <> b").distinct(), "links")
        drop_kept(before)
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
    found.kept_path = links.kept_path
    return found
