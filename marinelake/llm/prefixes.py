"""The prefix trie of rebuilt conversations, by collapse of whole sequences.

Identical conversations become one sequence with a weight and a list of its members.
The prefixes of the distinct sequences, aggregated with their weights, are the nodes;
sequences that are no proper prefix of another, found by an anti-join, are the leaves.

A turn is known by a digest, and the prefix that ends in it by the exclusive or of hashes
of (place, digest). That needs no order of evaluation, so a conversation may be spread
over tasks: running values are carried from one block of its turns to the next.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import drop_kept, kept_table
from marinelake.llm.registry import query, table

#: Every conversation begins with turns of the first one of its group of ids.
GROUP = 5
#: The turns taken from there are fewer than this.
MOST_TAKEN = 9
#: Turns of a conversation and members of a sequence per block: 2^10.
BLOCK_BITS = 10
NODE = ["depth", "x1", "x2"]
_FIRST_BLOCK = -(1 << 62)


def block_of(order: Column) -> Column:
    """Blocks of consecutive values; what has no value is the first block."""
    return F.coalesce(F.shiftright(order, BLOCK_BITS), F.lit(_FIRST_BLOCK))


def running(rows: DataFrame, key: str, by: str, order: list[Column], values: dict[str, tuple[str, Column]], backwards: bool = False) -> DataFrame:
    """Add the running ``sum`` or ``xor`` of columns over each key, the row included.

    ``by`` cuts a key into blocks and ``order`` orders the rows of a block; ``backwards``
    runs from the last row on. A key of any length is spread over its blocks: their totals
    are combined before the shuffle, and one row per block crosses to the next."""
    together = {"sum": F.sum, "xor": F.bit_xor}
    cut = rows.withColumn("_block", block_of(F.col(by)))
    totals = cut.groupBy(key, "_block").agg(*[together[how](x).alias(f"_{name}") for name, (how, x) in values.items()])
    at = F.col("_block").desc() if backwards else F.col("_block")
    earlier = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(key).alias("_key"), F.col("_block").alias("_of"), *[together[how](f"_{name}").over(earlier).alias(f"_{name}") for name, (how, _) in values.items()]
    ).where(F.coalesce(*[f"_{name}" for name in values]).isNotNull())
    inside = Window.partitionBy(key, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def added(name: str, how: str, column: Column) -> Column:
        before, here = F.coalesce(f"_{name}", F.lit(0)), F.coalesce(together[how](column).over(inside), F.lit(0))
        return (before + here if how == "sum" else before.bitwiseXOR(here)).cast("bigint").alias(name)

    joined = cut.join(carried, (F.col(key) == F.col("_key")) & (F.col("_block") == F.col("_of")), "left")
    return joined.select(*rows.columns, *[added(name, how, x) for name, (how, x) in values.items()])


def numbered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, digest, bytes``: the turns of every conversation from 0 on, those
    without a number first; turns of one number are ordered by their digest. Rows without
    an id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    # The length of the role says where it ends.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    placed = running(rows, "conv_id", "turn", order, {"place": ("sum", F.lit(1))})
    return placed.select("conv_id", (F.col("place") - 1).alias("pos"), "digest", "bytes")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """The turns of every rebuilt conversation: the first ``h`` turns of the conversation
    that leads its group, as many as there are, then its own from its ``h``-th on.

    A leading conversation keeps its turns. At most ``MOST_TAKEN - 1`` turns of a leader
    meet each of its group's conversations."""
    c = F.col("conv_id")
    taken = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(MOST_TAKEN)).alias("h")
    leads = c % GROUP == 0
    heads = turns.where(leads & (F.col("pos") < MOST_TAKEN - 1)).withColumnRenamed("conv_id", "leader")
    lengths = heads.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    others = turns.where(~leads).select("conv_id").distinct().select("conv_id", (c - c % GROUP).alias("leader"), taken)
    borrowed = others.join(heads, "leader").where("pos < h").select("conv_id", "pos", "digest", "bytes")
    shift = others.join(lengths, "leader", "left").select("conv_id", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("m"))
    own = turns.where(~leads).join(shift, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "bytes")
    return turns.where(leads).unionByName(borrowed).unionByName(own)


def _hashes() -> list[Column]:
    """Two hashes of a turn at its place."""
    return [F.xxhash64("digest", "pos"), F.xxhash64(F.lit(1), "pos", "digest")]


def ends_digests(members: DataFrame) -> DataFrame:
    """``depth, x1, x2, ends_sha256`` of each sequence: the digest of its members' ids in
    ascending order, joined by commas.

    Ids are gathered by blocks of their values, of at most 2^10 members, and the blocks
    of a sequence are fed to its digest one after another: a sequence with many members
    is never held whole, and what reaches one task is a row per block."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = members.groupBy(*NODE, F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(ids.alias("ids"))
    dealt = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digest_rows(done)
        if node is not None:
            yield _digest_rows([(*node, state.hexdigest())])

    return dealt.mapInArrow(digest, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [*NODE, "ends_sha256"])


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.

    Null roles and texts count as empty, and rows without a conversation id as absent;
    a conversation whose turns were all left out ends at the root. Repeated rows are
    repeated turns. Turns of equal number are ordered by digest. No conversations, no
    rows. A prefix or sequence that many conversations share is combined before every
    shuffle, and only rows per distinct sequence remain after the first."""
    turns = kept_table(numbered_turns(conversations, conv_id, turn, role, text), "turns")
    rebuilt = kept_table(rebuilt_turns(turns), "rebuilt")
    # A row without a turn keeps the conversations that lost all of theirs.
    marked = rebuilt.select("conv_id", F.lit(1).alias("n"), *[x.alias(f"e{i}") for i, x in enumerate(_hashes())]).union(
        turns.select("conv_id", F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")).distinct()
    )
    members = kept_table(
        marked.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("e0").alias("x1"), F.bit_xor("e1").alias("x2")), "members"
    )
    sequences = kept_table(members.groupBy(*NODE).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("sequence")), "sequences")
    ends = kept_table(ends_digests(members), "ends")

    e1, e2 = _hashes()
    about = sequences.select("sequence", "weight", F.col("depth").alias("length"))
    steps = rebuilt.withColumnRenamed("conv_id", "sequence").join(about, "sequence").withColumns({"e1": e1, "e2": e2})
    walked = running(steps, "sequence", "pos", [F.col("pos")], {"x1": ("xor", F.col("e1")), "x2": ("xor", F.col("e2"))})
    none = F.lit(None).cast("bigint")
    prefixes = kept_table(
        walked.select("sequence", "weight", "length", (F.col("pos") + 1).alias("depth"), "x1", "x2",
                      F.col("x1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("e2")).alias("p2"), "bytes")
        .union(about.select("sequence", "weight", "length", *[F.lit(0).cast("bigint")] * 3, none, none, F.lit(0).cast("bigint"))),
        "prefixes",
    )
    drop_kept(turns, rebuilt, members)

    proper = prefixes.where("depth < length").select(*NODE).distinct()
    leaves = sequences.join(proper, NODE, "left_anti").select("sequence", F.lit(1).alias("leaf"))
    nodes = kept_table(
        prefixes.join(leaves, "sequence", "left").groupBy(*NODE).agg(
            F.sum("weight").alias("n_convs"), F.min("sequence").alias("conv_id"), F.count("leaf").alias("n_leaves"),
            F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("bytes").alias("bytes"),
        ).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")),
        "nodes",
    )

    # Each node's saving is booked on one sequence, that of its smallest member. Summed
    # from the end of every sequence, and then over the sequences through a node, it
    # counts once in every node above.
    booked = nodes.select(F.col("conv_id").alias("sequence"), "depth", "saved")
    below = running(prefixes.join(booked, ["sequence", "depth"], "left"), "sequence", "depth", [F.col("depth").desc()], {"saved_tokens": ("sum", F.col("saved"))}, backwards=True)
    absent = F.lit(None).cast("string")
    facts = (
        below.select(*NODE, "saved_tokens", F.lit(0).alias("n_children"), absent.alias("ends_sha256"))
        .union(nodes.where("depth > 0").select(F.col("depth") - 1, "p1", "p2", F.lit(0), F.lit(1), absent))
        .union(ends.select(*NODE, F.lit(0), F.lit(0), "ends_sha256"))
        .groupBy(*NODE).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_children").alias("n_children"), F.max("ends_sha256").alias("ends_sha256"))
    )
    # A parent with many children is a hot key of this join alone, which the adaptive skew
    # join splits on the children's side.
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(parents, ["depth", "p1", "p2"], "left")
    return known.join(facts, NODE).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
        lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""

_SQL = f"""
WITH t AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT c, c - c % {GROUP} AS leader, {_CRC32} % {MOST_TAKEN} AS h FROM (SELECT DISTINCT c FROM t)
), r AS (
    SELECT convs.c, pos, role, text FROM convs JOIN t ON t.c = leader WHERE pos < h
    UNION ALL SELECT convs.c, pos, role, text FROM convs JOIN t ON t.c = convs.c WHERE pos >= h
), seqs AS (
    SELECT c, coalesce(s, []) AS s FROM convs LEFT JOIN (
        SELECT c, list({{'role': role, 'text': text}} ORDER BY pos) AS s FROM r GROUP BY c) USING (c)
), nodes AS (
    SELECT d, s[1:d] AS p, min(c) AS conv_id, count(*) AS n, coalesce(strlen(any_value(s[d].text)), 0) AS bytes,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends,
           bool_and(len(s) = d) AS childless
    FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs) GROUP BY ALL
), above AS (
    SELECT a AS d, p[1:a] AS p, sum((n - 1) * bytes) AS saved, count(*) FILTER (WHERE childless) AS leaves,
           count(*) FILTER (WHERE d = a + 1) AS children
    FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, a.children AS n_children,
       a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN above a USING (d, p) LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""


@query("op11_conversation_prefix_trie", _SQL)
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
