"""Near-duplicate documents by improved consistent weighted sampling.

Documents are weighted sets of word shingles: term frequency times a damped inverse
document frequency. Each of 64 samples of a set is equal for two documents with the
probability of their weighted Jaccard similarity; bands of four samples give
candidates, the similarity itself decides.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import ROWS_A_TASK, drop_kept, free_name, kept_table, lean, slices, spread, text_rows, texts_of
from marinelake.llm.components import components
from marinelake.llm.registry import query, table
from marinelake.llm.words import SHINGLE, distinct, mix, shingles, word_hashes

SIMILARITY = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
#: Document frequencies are counted in this many counters by shingle hash, over all documents.
COUNTERS_LOG2 = 18
#: A shingle of one document weighs 1 + IDF_RANGE, one of all documents weighs 1:
#: a large group of copies must not lose what its members share.
IDF_RANGE = 0.25
#: Bits kept of every sample, and how many of the 64 samples may differ in them. At
#: similarity 0.8 more than 24 do in fewer than 1 of 10,000 pairs.
SKETCH_PLANES = 4
SKETCH_DIFFERS = 24
#: Bits of a text's odd sketch: of each bit, whether an odd number of its shingles fall there.
ODD_BITS = 1024
#: Tasks that the comparisons with one leader are dealt over.
LEADER_PARTS = 256
#: Pairs that one task compares where they are few.
PAIRS_A_TASK = 500
#: What tells without the texts that two of them are not similar.
_PROFILE = ["marks", "sketch", "odd", "weight"]
_SLICE = 2 << 20
_BLOCK = 1 << 14


def _gamma2_quantiles(n: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of n equal parts."""
    u = (np.arange(n) + 0.5) / n
    lo, hi = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (lo + hi) / 2
        below = 1 - (1 + x) * np.exp(-x) < u
        lo, hi = np.where(below, x, lo), np.where(below, hi, x)
    return (lo + hi) / 2


class Sampler:
    """Samples of weighted sets. Tables come from the driver, so all tasks agree bit by bit."""

    def __init__(self, frequencies: np.ndarray, documents: int):
        self.scale = _gamma2_quantiles(1 << 16)
        self.log_c = np.log(self.scale)
        rarity = np.log(max(documents, 2) / np.clip(frequencies, 1, max(documents, 1))) / np.log(max(documents, 2))
        self.idf = 1 + IDF_RANGE * rarity
        self.multipliers = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
        # Shingles at or above this weight are in odd sketches: the weight times their share is largest.
        order = np.argsort(-self.idf, kind="stable")
        share = np.cumsum(frequencies[order])
        self.counted = float(self.idf[order[np.argmax(self.idf[order] * share)]])

    def weights(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts * self.idf[(values >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)]

    def samples(self, values: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of samples per set: ln a of the element taken, which identifies it
        together with its quantised weight. Sets without elements get infinity."""
        n = len(offsets) - 1
        out = np.full((SAMPLES, n), np.inf)
        log_w = np.log(weights)
        for lo in range(0, len(values), _BLOCK):
            hi = min(lo + _BLOCK, len(values))
            first = int(np.searchsorted(offsets, lo, "right")) - 1
            last = int(np.searchsorted(offsets, hi, "left"))
            heads = np.maximum(offsets[first:last], lo) - lo
            full = np.diff(np.append(heads, hi - lo)) > 0
            sets, heads = np.arange(first, last)[full], heads[full]
            x, lw = values[lo:hi], log_w[lo:hi]
            for k in range(SAMPLES):
                h = x * self.multipliers[k]
                r = self.scale[(h >> np.uint64(48)).astype(np.int64)]
                beta = ((h >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float64) * (1 / 65536)
                t = np.floor(lw / r + beta)
                a = self.log_c[((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)] - r * (t - beta + 1)
                out[k, sets] = np.minimum(out[k, sets], np.minimum.reduceat(a, heads))
        return out.T


    def odd(self, values: np.ndarray, counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of ``ODD_BITS`` bits per set, as 64-bit words. Every occurrence of a
        shingle turns one bit over, so the bits in which two sets differ are at most as
        many as the occurrences that only one of them has."""
        n = len(offsets) - 1
        owner = np.repeat(np.arange(n), np.diff(offsets))
        some = np.flatnonzero(self.weights(values, 1) >= self.counted)
        times = counts[some]
        nth = spread(np.zeros(len(some), np.int64), times).astype(np.uint64)
        bit = mix(np.repeat(values[some], times) + nth * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(ODD_BITS - 1)
        held = np.bincount(np.repeat(owner[some], times) * ODD_BITS + bit.astype(np.int64), minlength=n * ODD_BITS)
        return np.packbits((held & 1).astype(bool)).view(np.int64).reshape(n, ODD_BITS // 64)


def weighted_jaccards(sets, other, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sum of the smaller over sum of the larger weights, for pairs of sets ``i`` of
    ``sets`` and ``j`` of ``other`` (each: sorted values, weights, offsets of its sets)."""
    (va, wa, oa), (vb, wb, ob) = sets, other
    out = np.zeros(len(i))
    order = np.argsort(j, kind="stable")
    for pairs in np.split(order, np.flatnonzero(np.diff(j[order])) + 1) if len(order) else []:
        b, w = (x[ob[j[pairs[0]]] : ob[j[pairs[0]] + 1]] for x in (vb, wb))
        lengths = oa[i[pairs] + 1] - oa[i[pairs]]
        if not len(b) or not lengths.all():
            some = np.flatnonzero(lengths) if len(b) else []
            pairs, lengths = pairs[some], lengths[some]
            if not len(pairs):
                continue
        # A call takes a bounded number of values.
        for part in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(np.cumsum(lengths) >> 20)) + 1):
            at, heads = spread(oa[i[pairs[part]]], lengths[part]), np.cumsum(lengths[part]) - lengths[part]
            x, own = va[at], wa[at]
            place = np.minimum(np.searchsorted(b, x), len(b) - 1)
            shared = np.add.reduceat(np.where(b[place] == x, np.minimum(own, w[place]), 0.0), heads)
            out[pairs[part]] = shared / (np.add.reduceat(own, heads) + w.sum() - shared)
    return out


def _sets(texts: pa.StringArray, size: int):
    return distinct(*shingles(*word_hashes(texts), size))


def document_frequencies(docs: DataFrame, size: int = SHINGLE) -> tuple[np.ndarray, int]:
    """How many of all rows hold a shingle of each counter, and how many rows there
    are. The driver gets the counters, a fixed number."""
    counters = 1 << COUNTERS_LOG2

    def count(batches):
        totals, rows = np.zeros(counters, np.int64), 0
        for batch in slices(batches, "text", most=_SLICE):
            values, _, offsets = _sets(texts_of(batch, "text"), size)
            counter = (values >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            totals += np.bincount(np.unique(owner << COUNTERS_LOG2 | counter) & (counters - 1), minlength=counters)
            rows += batch.num_rows
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(totals[at], rows))], ["counter", "n"])

    found = docs.select("text").mapInArrow(lean(count), "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counter, n = found.column("counter").to_numpy(), found.column("n").to_numpy()
    frequencies = np.zeros(counters, np.int64)
    frequencies[counter[counter >= 0]] = n[counter >= 0]
    return frequencies, int(n[counter < 0].sum())


def _signatures(texts: DataFrame, shared, size: int) -> DataFrame:
    """``key, bands, marks, sketch, odd, weight`` of each text that has a word; marks are 32
    bits of the bands, the sketch is the lowest bits of all samples, one word per bit,
    the odd sketch is of all shingles, the weight is their sum."""

    def sign(batches):
        sampler = shared.value
        for batch in slices(batches, "text", most=_SLICE):
            values, counts, offsets = _sets(texts_of(batch, "text"), size)
            some = np.flatnonzero(np.diff(offsets))
            weights = sampler.weights(values, counts)
            drawn = sampler.samples(values, weights, offsets)[some]
            odd = sampler.odd(values, counts, offsets)[some]
            total = np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), weights, len(offsets) - 1)[some]
            bits = np.ascontiguousarray(drawn).view(np.uint64).reshape(len(some), SAMPLES)
            hashed = mix(bits)
            bands = np.zeros((len(some), BANDS), np.uint64)
            for row in range(ROWS):
                bands = mix(bands * np.uint64(31) + hashed[:, row::ROWS])
            at = np.arange(SAMPLES, dtype=np.uint64)
            planes = [((hashed >> np.uint64(p) & np.uint64(1)) << at).sum(axis=1, dtype=np.uint64) for p in range(SKETCH_PLANES)]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().view(np.int64)))
                for x in (bands, np.stack(planes, axis=1), odd)
            ]
            marks = pa.ListArray.from_arrays(lists[0].offsets, pa.array(bands.ravel().astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(some)), lists[0], marks, *lists[1:], pa.array(total)], ["key", "bands", "marks", "sketch", "odd", "weight"]
            )

    return texts.select("key", "text").mapInArrow(
        lean(sign), "key string, bands array<bigint>, marks array<int>, sketch array<bigint>, odd array<bigint>, weight double"
    )


def _near(a: str, b: str) -> Column:
    """Whether two sketches allow the similarity."""
    differs = [F.col(a)[p].bitwiseXOR(F.col(b)[p]) for p in range(SKETCH_PLANES)]
    return F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), differs)) <= SKETCH_DIFFERS


def _may_reach(a: str, b: str, counted: float, similarity: float) -> Column:
    """Whether two texts can be as similar as that; never false for a pair that is.

    What only one of them has weighs at most (1 - s) / (1 + s) of both together if their
    similarity is s, and every bit in which the odd sketches differ is one shingle of that."""
    differs = [F.bit_count(F.col(f"{a}odd")[p].bitwiseXOR(F.col(f"{b}odd")[p])) for p in range(ODD_BITS // 64)]
    both = F.col(f"{a}weight") + F.col(f"{b}weight")
    return reduce(lambda x, y: x + y, differs) * F.lit(counted) <= both * F.lit((1 - similarity) / (1 + similarity) * (1 + 1e-9))


def _first_band(a: str, b: str) -> Column:
    """Whether no band before the one of the row is shared: of all buckets that two texts
    have in common the first one compares them."""
    return ~reduce(lambda x, y: x | y, [(F.col("band") > i) & (F.col(a)[i] == F.col(b)[i]) for i in range(BANDS - 1)])


def _verified(pairs: DataFrame, texts: DataFrame, shared, size: int, similarity: float) -> DataFrame:
    """The pairs (``a, b``) that are similar enough, and ``similarity``."""

    def verify(batches):
        sampler = shared.value
        for batch in slices(batches, "text_a", "text_b", most=_SLICE):
            sides = []
            for side in ("text_a", "text_b"):
                # A leader's text stands in many rows of a batch; its set is made once.
                coded = texts_of(batch, side).dictionary_encode()
                values, counts, offsets = _sets(coded.dictionary, size)
                sides.append(((values, sampler.weights(values, counts), offsets), coded.indices.to_numpy()))
            (one, i), (two, j) = sides
            found = weighted_jaccards(one, two, i, j)
            kept = pa.array(found >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept), pa.array(found).filter(kept)], ["a", "b", "similarity"])

    # A leader stands in many pairs: its text is dealt out in as many copies as parts.
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.lit(LEADER_PARTS)))
    leaders = pairs.select("b", "part").distinct().join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    sides = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(leaders, ["b", "part"])
    return sides.select("a", "b", "text_a", "text_b").mapInArrow(lean(verify), "a string, b string, similarity double")


def _crowded(signed: DataFrame) -> DataFrame:
    """``band, hash, key`` and the profile of the text, of the buckets of several texts, and ``central``: how
    many texts the buckets of a key hold, the more, the nearer it is to the middle of
    a group of near copies."""
    bucket = ["band", "hash"]
    bands = signed.select("key", F.posexplode("bands").alias("band", "hash"))
    sizes = bands.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = bands.join(sizes, bucket).groupBy("key").agg(F.sum("n").alias("central"), F.collect_list(F.struct(*bucket)).alias("own"))
    of_key = ["key", *_PROFILE, "central"]
    return own.join(signed.drop("bands"), "key").select(F.explode("own").alias("at"), *of_key).select("at.*", *of_key)


def similar_texts(texts: DataFrame, frequencies: np.ndarray, documents: int, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """``node, component`` of every text that is linked; ``texts`` holds ``key, text``,
    one key for each different text, in any number of rows. ``drop_kept`` deletes the
    table behind the result.

    In every turn the members of a bucket are compared with its leaders that are of
    other components, and the leaders leave the bucket, as nothing about them is open.
    Leaders are those of the smallest components, and among them the most central: the
    middle of a group settles most of it at once, and of a large component and a few
    others the few are the ones to lead. A bucket of one component is done. Each turn
    has four times as many leaders, so that turns are few; a bucket whose members are
    all unlike ends when all have led. Two texts meet in one of their buckets only, and
    are compared if their sketches allow the similarity. Tables of a turn are deleted
    when the next has been written; tables of few rows are written by few tasks, as a
    late turn has little to do."""
    spark = texts.sparkSession
    sampler = Sampler(frequencies, documents)
    shared = spark.sparkContext.broadcast(sampler)
    bucket = ["band", "hash"]
    signed = kept_table(_signatures(texts, shared, size).dropDuplicates(["key"]), "signatures")
    single = {"component": F.col("key"), "size": F.lit(1).cast("bigint")}
    members = kept_table(_crowded(signed).withColumns(single), "buckets")
    drop_kept(signed)
    wanted = members.select("key").distinct()
    texts = kept_table(texts.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "bucket-texts")
    linked = kept_table(spark.createDataFrame([], "node string, component string, size bigint"), "linked")
    rank = ["size", -F.col("central"), "key"]
    turn = 0
    while n := members.count():
        order = Window.partitionBy(*bucket).orderBy(*rank)
        leaders = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 4**turn)
        leaders = leaders.select(*bucket, F.struct(*rank).alias("rank"), F.struct("key", "component", *_PROFILE).alias("leader"))
        leaders = kept_table(leaders, "leaders", rows=n)
        met = members.join(leaders, bucket).where(F.struct(*rank) > F.col("rank")).where("component <> leader.component")
        met = met.where(_first_band("marks", "leader.marks")).where(_near("sketch", "leader.sketch"))
        met = met.where(_may_reach("", "leader.", sampler.counted, similarity))
        pairs = kept_table(met.select(F.col("key").alias("a"), F.col("leader.key").alias("b")), "pairs", rows=n * 4**turn)
        compared = pairs.count() * ROWS_A_TASK // PAIRS_A_TASK
        found = kept_table(_verified(pairs, texts, shared, size, similarity).select("a", "b"), "found", rows=compared)
        drop_kept(pairs)
        if not found.isEmpty():
            classes = components(found.union(linked.select("node", "component")))
            sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
            sized = classes.join(sizes, "component").select("node", "component", "size")
            before, linked = linked, kept_table(sized, "linked", rows=classes.count())
            drop_kept(before, classes)
        left = members.join(leaders.select(*bucket, F.col("leader.key").alias("key")), [*bucket, "key"], "left_anti").drop("component", "size")
        left = left.join(linked.withColumnRenamed("node", "key"), "key", "left").withColumns({c: F.coalesce(c, single[c]) for c in single})
        left = kept_table(left, "left", rows=n)
        several = left.groupBy(*bucket).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        before, members = members, kept_table(left.join(several.select(*bucket), bucket, "left_semi"), "buckets", rows=n)
        drop_kept(before, leaders, found, left)
        turn += 1
    drop_kept(members, texts)
    classes = linked.select("node", "component")
    classes.kept_path = linked.kept_path
    return classes


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, group_id, kept`` for every row.

    ``group_id`` is the smallest id of the rows linked by equal texts or by similarity
    at or above the threshold (null only if none of them has an id). Of a group the
    row with the smallest id is kept, null ids last; of rows that agree in id and
    text all are marked. A text without a word (null and empty ones too) is compared
    with nothing: its row is a group of its own and is kept. ``text_key`` is the
    text's digest. An empty table gives no rows."""
    rows = text_rows(docs, doc_id, text).withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    frequencies, documents = document_frequencies(rows, size)
    linked = similar_texts(rows.where("text is not null").select("key", "text"), frequencies, documents, similarity, size)
    named = (
        rows.select("doc_id", "key", (~F.coalesce("text", F.lit("")).rlike(r"[\p{L}\p{N}\p{M}]")).alias("wordless"))
        .join(linked.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("class", F.coalesce("component", "key"))
    )
    named = kept_table(named, "named")
    drop_kept(linked)
    first = named.where("not wordless").groupBy("class").agg(
        F.min("doc_id").alias("group_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first"),
    )
    joined = named.where("not wordless").join(first, "class")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    return joined.select("doc_id", F.col("key").alias("text_key"), "group_id", kept.alias("kept")).union(
        named.where("wordless").select("doc_id", "key", F.col("doc_id").alias("group_id"), F.lit(True))
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one row of each group; columns as they are."""
    text_key, row_id, n = (free_name(docs, x) for x in ("text_key", "row_id", "n"))
    text, doc_id = options.get("text", "text"), options.get("doc_id", "doc_id")
    found = near_duplicates(docs, **options)
    kept = found.where("kept").groupBy(F.col("text_key").alias(text_key), F.col("doc_id").alias(row_id)).agg(F.count(F.lit(1)).alias(n))
    keyed = docs.withColumn(text_key, F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    same = (keyed[text_key] == kept[text_key]) & keyed[doc_id].cast("bigint").eqNullSafe(kept[row_id])
    stay = keyed.join(kept, same).drop(kept[text_key]).drop(row_id)
    wordless = ~F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[\p{L}\p{N}\p{M}]")
    alone = stay.where((F.col(n) == 1) | wordless)
    repeated = stay.where((F.col(n) > 1) & ~wordless).dropDuplicates([text_key, doc_id])
    return alone.union(repeated).select(*docs.columns)


@query("op6_minhash_near_dedup")
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
