"""Near-duplicate passages by compact windows.

Under one hash function every run of word shingles has its minimum at one place; the
runs that share a place form a compact window, a node of the Cartesian tree over the
hashes. Only nodes whose window has the length of a passage matter. Windows of equal
minimum and equal minimum signature of what stands before or after it are joined
over several hash functions; the texts themselves decide.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import free_name, kept_table, lean, slices, spread, text_rows, texts_of
from marinelake.llm.registry import query, table
from marinelake.llm.words import SHINGLE, mix, placed_words, shingles

SIMILARITY = 0.8
#: Words of a passage.
PASSAGE_WORDS = 50
#: Hash functions. One meeting is enough for a check: an exact passage meets in all.
HASHES = 4
#: Matched runs at most so far apart (in shingles) may be one passage.
NEAR = 16
#: Shingles by which matches may leave the common alignment: insertions and deletions.
SHIFT = 64
#: Windows that a task holds before it combines those of one signature.
HELD = 1_500_000
#: Windows of either side in one block of the comparison within a signature, and rows
#: of small signatures that one call gets together.
BLOCK = 1024
TOGETHER = 20_000
#: Kinds of rows that :func:`meetings` deals out.
_ALONE, _LEAD, _FURTHER, _PAIR = range(4)
_SLICE = 2 << 20
_LAST = np.iinfo(np.int64).max
_SEEDS = mix(np.arange(101, 101 + 3 * HASHES, dtype=np.uint64)).reshape(3, HASHES) | np.uint64(1)


def _sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    """Minimum of v[p : p + n] for every p with a full window."""
    done, out = 1, v
    while done * 2 <= n:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    return np.minimum(out[: len(v) - n + 1], out[n - done : n - done + len(v) - n + 1]) if done < n else out


def compact_windows(v: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Places whose compact window is at least ``width`` long: the minima of some
    window of that length inside one text, all of equal ones."""
    if len(v) < width:
        return np.zeros(0, np.int64)
    least = _sliding_min(v, width)
    whole = owner[: len(v) - width + 1] == owner[width - 1 :]
    least = np.where(whole, least, 0)
    # The largest of the minima of all windows over a place equals its value only there.
    padded = np.concatenate([np.zeros(width - 1, v.dtype), least, np.zeros(width - 1, v.dtype)])
    top = ~_sliding_min(~padded, width)
    return np.flatnonzero((top == v) & (top > 0))


def signatures(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, signature`` of all windows: per hash function the minimum together with
    two further minima over half a passage before it, and over half a passage after
    it, where the window reaches as far."""
    side = width // 2
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    places, found = [], []
    for k in range(HASHES):
        v, second, third = (mix(values * s) | np.uint64(1) for s in _SEEDS[:, k])
        at = compact_windows(v, owner, width)
        if not len(at):
            continue
        own, two, three = (_sliding_min(x, side) for x in (v, second, third))
        for before in (True, False):
            start = at - side + 1 if before else at
            fits = (start >= 0) & (start + side <= len(v))
            c, start = at[fits], start[fits]
            inside = (owner[start] == owner[start + side - 1]) & (own[start] == v[c])
            c, start = c[inside], start[inside]
            places.append(c)
            found.append(mix(mix(mix(v[c] + np.uint64(2 * k + before)) + two[start]) + three[start]))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(found)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the first of all equal pairs, in the order of the pairs."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order[new]


def _chained(signature: np.ndarray, order: np.ndarray, text: np.ndarray, carried=None):
    """Pairs of texts of one signature, each text with the first one and with the one
    before it; rows sorted by signature, order, text. ``carried``: signature, first and
    last text of the row before. Returns later and earlier texts and what to carry on."""
    if not len(signature):
        return text[:0], text[:0], carried
    new = np.ones(len(signature), bool)
    new[1:] = signature[1:] != signature[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    first, before = text[head], np.concatenate([text[:1], text[:-1]])
    if carried is not None and carried[0] == signature[0]:
        run = head == 0
        first = np.where(run, carried[1], first)
        before[0] = carried[2]
        new[0] = False
    later = np.concatenate([text[~new], text[~new]])
    earlier = np.concatenate([first[~new], before[~new]])
    differ = later != earlier
    later, earlier = later[differ], earlier[differ]
    at = _distinct_pairs(later, earlier)
    return later[at], earlier[at], (signature[-1], first[-1], text[-1])


def meetings(rows: DataFrame, width: int) -> DataFrame:
    """``a, b, signature, place``: texts (hashes of them) that share a signature, b first
    in order, each with the first and the one before it; and, with null ``b``, every
    text of a signature that several rows have, with the place (in shingles) of its window.

    ``rows`` holds ``doc_id, tid, text``. Each task combines its own windows before the
    shuffle: one row per signature goes to the signature's partition, further ones are
    dealt out by text, so a passage of a third of all documents is no large partition.
    Sorted partitions are read as streams."""
    names = ["kind", "signature", "ord", "a", "b", "place"]

    def dealt(kind: int, n: int, **columns):
        columns = {"kind": np.full(n, kind, np.int8), **columns}
        return pa.RecordBatch.from_arrays([pa.array(columns[c]) if c in columns else pa.array([None] * n, pa.int64()) for c in names], names)

    def combine(batches):
        held: list[np.ndarray] = []
        total = 0

        def flush():
            nonlocal held, total
            signature, order, text, place = np.concatenate(held, axis=1)
            at = np.lexsort((text, order, signature))
            signature, order, text, place = signature[at], order[at], text[at], place[at]
            a, b, _ = _chained(signature, order, text)
            lead = np.ones(len(signature), bool)
            lead[1:] = signature[1:] != signature[:-1]
            head = np.flatnonzero(lead)
            of_lead = text[np.repeat(head, np.diff(np.append(head, len(text))))]
            # A copy of the text before it adds no member.
            further = text != of_lead
            further[1:] &= (text[1:] != text[:-1]) | lead[1:]
            several = np.add.reduceat(further.astype(np.int64), head) > 0
            held, total = [], 0
            for kind, some in ((_ALONE, head[~several]), (_LEAD, head[several]), (_FURTHER, np.flatnonzero(further))):
                yield dealt(kind, len(some), signature=signature[some], ord=order[some], a=text[some], place=place[some])
            # By its own hash, a pair that several tasks find comes together.
            yield dealt(_PAIR, len(a), signature=mix(a.view(np.uint64)).view(np.int64), a=a, b=b)

        for batch in slices(batches, "text", most=_SLICE):
            hashes, _, _, words = placed_words(texts_of(batch, "text"))
            values, offsets = shingles(hashes, words)
            place, signature = signatures(values, offsets, width)
            row = np.searchsorted(offsets, place, "right") - 1
            tid = batch.column("tid").to_numpy()
            # A text has one row per signature, wherever it stands in it.
            signature = signature.view(np.int64)
            first = _distinct_pairs(signature, row)
            row = row[first]
            held.append(np.stack([signature[first], batch.column("doc_id").fill_null(_LAST).to_numpy()[row], tid[row], place[first] - offsets[row]]))
            total += len(row)
            if total >= HELD:
                yield from flush()
        if held:
            yield from flush()

    def chain(batches):
        carried = kept = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            lead = kind <= _LEAD
            leads = batch.filter(pa.array(lead))
            columns = [leads.column(c).to_numpy() for c in ("signature", "ord", "a", "place")]
            a, b, carried = _chained(*columns[:3], carried)
            # Members: leads that have company here or in their own task.
            signature, _, text, place = columns
            same = np.zeros(len(signature), bool)
            same[1:] = signature[1:] == signature[:-1]
            if len(signature) and kept is not None and kept[0] == signature[0]:
                same[0] = True
                if not kept[3]:  # the last row of the batch before has company after all
                    yield pa.RecordBatch.from_arrays([pa.array([kept[1]]), pa.array([None], pa.int64()), pa.array([kept[0]]), pa.array([kept[2]])], ["a", "b", "signature", "place"])
            member = same | (kind[lead] == _LEAD)
            member[:-1] |= same[1:]
            if len(signature):
                kept = signature[-1], text[-1], place[-1], bool(member[-1])
            known = batch.filter(pa.array(kind == _PAIR))
            further = batch.filter(pa.array(kind == _FURTHER))
            n = int(member.sum()) + further.num_rows
            none = lambda m: pa.array([None] * m, pa.int64())
            pairs = len(a) + known.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(a), known.column("a"), pa.array(text[member]), further.column("a")]),
                    pa.concat_arrays([pa.array(b), known.column("b"), none(n)]),
                    pa.concat_arrays([none(pairs), pa.array(signature[member]), further.column("signature")]),
                    pa.concat_arrays([none(pairs), pa.array(place[member]), further.column("place")]),
                ],
                ["a", "b", "signature", "place"],
            )

    windows = rows.mapInArrow(lean(combine), "kind tinyint, signature bigint, ord bigint, a bigint, b bigint, place bigint")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("kind") == _FURTHER, F.col("a")).otherwise(0)
    ordered = windows.repartition(parts, F.col("signature"), salt).sortWithinPartitions("signature", "ord", "a")
    return ordered.mapInArrow(lean(chain), "a bigint, b bigint, signature bigint, place bigint").distinct()


def _around(values: np.ndarray, place: int, width: int) -> np.ndarray:
    return values[max(place - 2 * width, 0) : place + 2 * width + 1]


def _densest(match: np.ndarray, share: float, width: int) -> np.ndarray:
    """Per row, the most matches beyond ``share`` of the places of a run of ``width`` or more."""
    sums = np.zeros((match.shape[0], match.shape[1] + 1))
    np.cumsum(match - share, axis=1, out=sums[:, 1:])
    low = np.minimum.accumulate(sums[:, : match.shape[1] - width + 1], axis=1)
    return (sums[:, width:] - low).max(axis=1)


def may_share(where: np.ndarray, repeats: int, other_repeats: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """For each row of places (of the first equal shingle of the other run, or -1) whether
    :func:`shared_runs` can find a run; never false where it does.

    Any run that it takes has the length, and its matches are at least the similarity's share
    of the distinct shingles of both sides. Either side has at least as many as match; the
    other one's stretch is shorter at most by what the shifts of matches differ. ``repeats``
    of both runs: places whose shingle stands at an earlier place too. Matches less than
    ``NEAR`` apart are as long as a run, or nearly all that such a run has."""
    n = where.shape[1]
    if n < width:
        return np.zeros(len(where), bool)
    match, at = where >= 0, np.arange(n)
    share = similarity / (1 + similarity)
    before = np.full(where.shape, -n - NEAR)
    before[:, 1:] = np.maximum.accumulate(np.where(match, at, -n - NEAR), axis=1)[:, :-1]
    opens = match & (at - before > NEAR)
    start = np.maximum.accumulate(np.where(opens, at, 0), axis=1)
    count = np.cumsum(match, axis=1)
    inside = count - np.take_along_axis(count, start, axis=1) + 1
    some = (match & ((at - start + 1 >= width) | (inside >= 2 * share * width))).any(axis=1)
    shift = where - at
    differ = np.where(match, shift, -2 * n).max(axis=1) - np.where(match, shift, shift.max(initial=0)).min(axis=1)
    own = _densest(match, similarity, width) >= -similarity * repeats - 1e-9
    return some & own & (_densest(match, 2 * share, width) >= -share * (differ + repeats + other_repeats) - 1e-9)


def near_partners(seekers: list[np.ndarray], stored: list[np.ndarray], earlier: Callable, width: int, similarity: float) -> list[tuple[int, int]]:
    """For each seeker one stored run of shingles that holds a similar passage, if any
    does: ``seeker, stored``. ``earlier(i)`` tells which stored ones it may have. The runs
    that share most are tried first, and all whose matches can make a run."""
    other = [places_of(x) for x in stored]
    lengths = np.array([len(x) for x, _, _ in other])
    repeats = np.array([len(x) for x in stored]) - lengths
    values, place = (np.concatenate([x[c] for x in other]) for c in (0, 1))
    owner = np.repeat(np.arange(len(other)), lengths)
    order = np.argsort(values, kind="stable")
    values, owner, place = values[order], owner[order], place[order]
    out = []
    for i, seeker in enumerate(seekers):
        x, at = np.unique(seeker, return_inverse=True)
        lo, hi = np.searchsorted(values, x), np.searchsorted(values, x, "right")
        found = spread(lo, hi - lo)
        holders = owner[found]
        shared = np.bincount(holders, minlength=len(other))
        # A run of that width has at least so many distinct shingles.
        least = similarity * max(width - (len(seeker) - len(x)), 1)
        fits = np.flatnonzero((shared >= least) & earlier(i))
        if len(fits):
            row = np.full(len(other), -1)
            row[fits] = np.arange(len(fits))
            where = np.full((len(fits), len(x)), -1)
            which, value = row[holders], np.repeat(np.arange(len(x)), hi - lo)
            some = which >= 0
            where[which[some], value[some]] = place[found[some]]
            fits = fits[may_share(where[:, at], len(seeker) - len(x), repeats[fits], width, similarity)]
        own = places_of(seeker) if len(fits) else None
        for j in fits[np.argsort(-shared[fits], kind="stable")]:
            if shared_runs(seeker, stored[j], width, similarity, None, (own, other[j])):
                out.append((i, int(j)))
                break
    return out


def further_pairs(members: DataFrame, spans: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """``a, b``: partners of windows that no verified passage covers.

    A shared signature proves no shared passage, and similarity is not transitive: a
    window that is not similar to the first of its signature may be to any other. Each
    open window is compared, shingles around it with shingles around it, with those of
    all earlier texts of the signature, in blocks, until one is similar."""
    spark = members.sparkSession
    covered = spans.select(F.col("a").alias("tid"), "from", "to")
    here = (F.col("m.tid") == F.col("c.tid")) & (F.col("place") >= F.col("from")) & (F.col("place") < F.col("to"))
    is_open = members.alias("m").join(covered.alias("c"), here, "left_anti").select("signature", "tid").withColumn("open", F.lit(True))
    ranked = members.join(is_open, ["signature", "tid"], "left").join(texts.select("tid", F.coalesce("doc_id", F.lit(_LAST)).alias("ord")), "tid")
    ranked = kept_table(ranked.withColumn("open", F.coalesce("open", F.lit(False))), "passage-members")
    rank = F.struct("ord", "tid")
    # The first text of a signature has no earlier one; two texts have been compared.
    groups = ranked.groupBy("signature").agg(
        F.count(F.lit(1)).alias("n"), F.min(rank).alias("first"), F.max(F.when(F.col("open"), rank)).alias("last"), F.sum(F.col("open").cast("int")).alias("k")
    ).where("n > 2 and last > first")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sized = ranked.join(groups.select("signature", "first", "last", blocks("n").alias("stored"), blocks("k").alias("seeking")), "signature")
    wanted = sized.where(rank <= F.col("last")).withColumn("open", F.col("open") & (rank > F.col("first")))
    listed = wanted.groupBy("tid", "ord").agg(F.collect_list(F.struct("signature", "place", "open", "stored", "seeking")).alias("windows"))

    def runs(batches):
        for batch in slices(batches, "text", most=_SLICE):
            hashes, _, _, words = placed_words(texts_of(batch, "text"))
            values, offsets = shingles(hashes, words)
            windows = batch.column("windows")
            lengths = windows.value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lengths)
            flat = windows.flatten()
            place = flat.field("place").to_numpy()
            around = [_around(values[offsets[r] : offsets[r + 1]], int(p), width).tobytes() for r, p in zip(row, place)]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(c) for c in ("signature", "open", "stored", "seeking")), batch.column("tid").take(at), batch.column("ord").take(at), pa.array(around, pa.binary())],
                ["signature", "open", "stored", "seeking", "tid", "ord", "around"],
            )

    placed = listed.join(texts.select("tid", "text"), "tid").mapInArrow(
        lean(runs), "signature bigint, open boolean, stored int, seeking int, tid bigint, ord bigint, around binary"
    )
    placed = kept_table(placed, "passage-windows")
    calls = max(1, placed.count() // TOGETHER)
    cut = lambda c: F.pmod(F.xxhash64("tid"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    sides = (
        placed.where("open").withColumn("seeks", F.lit(True)).withColumn("q", cut("seeking")).withColumn("s", every("stored"))
        .unionByName(placed.withColumn("seeks", F.lit(False)).withColumn("s", cut("stored")).withColumn("q", every("seeking")))
    )
    small = (F.col("stored") == 1) & (F.col("seeking") == 1)
    unit = F.when(small, F.pmod(F.xxhash64("signature"), F.lit(calls))).otherwise(F.xxhash64("signature", "q", "s"))

    def compare(block):
        signature, q, s, seeks, tid, order = (block.column(c).to_numpy() for c in ("signature", "q", "s", "seeks", "tid", "ord"))
        around = block.column("around").to_pylist()
        at = np.lexsort((seeks, s, q, signature))
        new = np.flatnonzero((np.diff(signature[at]) != 0) | (np.diff(q[at]) != 0) | (np.diff(s[at]) != 0)) + 1
        a, b = [], []
        for group in np.split(at, new):
            left, right = group[seeks[group]], group[~seeks[group]]
            if not len(left) or not len(right):
                continue
            before = lambda i: (order[right] < order[left[i]]) | ((order[right] == order[left[i]]) & (tid[right] < tid[left[i]]))  # noqa: B023, E731
            parts = [[np.frombuffer(around[k], np.uint64) for k in side] for side in (left, right)]
            for i, j in near_partners(*parts, before, width, similarity):
                a.append(tid[left[i]])
                b.append(tid[right[j]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # Dealt out by number: a call's work is not told by its bytes, by which small partitions would be joined.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sides.withColumn("unit", unit).select("unit", "signature", "q", "s", "seeks", "tid", "ord", "around").repartition(parts, "unit")
    return dealt.groupBy("unit").applyInArrow(compare, "a bigint, b bigint").distinct()


def places_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, sorted, the first place of each, and for every place the one
    before it with the same value, or -1."""
    order = np.argsort(x, kind="stable")
    values = x[order]
    new = np.ones(len(x), bool)
    new[1:] = values[1:] != values[:-1]
    before = np.full(len(x), -1)
    again = np.flatnonzero(~new)
    before[order[again]] = order[again - 1]
    return values[new], order[new], before


def _n_distinct(before: np.ndarray, lo: int, hi: int) -> int:
    """How many different values stand at the places from ``lo`` to before ``hi``."""
    return int(np.count_nonzero(before[lo:hi] < lo))


def _median(x: np.ndarray) -> float:
    x = np.sort(x)
    return (x[(len(x) - 1) // 2] + x[len(x) // 2]) / 2


def _widened(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: int, similarity: float, words) -> tuple[int, int] | None:
    """The run around matches ``i`` (in ``b``: ``j``) that are less than ``least`` apart,
    of that length, if it is similar to the run of ``b`` beside it: words changed near
    the end of a passage leave no match there. Of several runs the one with most equal
    words beside the matches, the middle one of equals."""
    need = least - (int(i[-1] - i[0]) + 1)
    shift = int(_median(j - i))
    start, best = int(i[0]), None
    middle = need / 2
    for left in sorted(range(need + 1), key=lambda n: abs(n - middle)):
        lo = start - left
        if lo < 0 or lo + shift < 0 or lo + least > len(a) or lo + shift + least > len(b):
            continue
        own, other = np.unique(a[lo : lo + least]), np.unique(b[lo + shift : lo + shift + least])
        e = len(np.intersect1d(own, other, assume_unique=True))
        if e < similarity * (len(own) + len(other) - e):
            continue
        n = least + SHINGLE - 1
        equal = 0 if words is None else int((words[0][lo : lo + n] == words[1][lo + shift : lo + shift + n]).sum())
        if best is None or equal > best[0]:
            best = equal, (lo, lo + least)
        if words is None:
            break
    return best and best[1]


def _similar_windows(i: np.ndarray, least: int, enough: float) -> list[tuple[int, int]]:
    """Unions of the windows of ``least`` shingles that hold at least ``enough`` of the matches ``i``."""
    if len(i) < enough:
        return []
    there = np.zeros(max(int(i[-1] - i[0]) + 1, least), np.int64)
    there[i - i[0]] = 1
    sums = np.concatenate([[0], np.cumsum(there)])
    starts = np.flatnonzero(sums[least:] - sums[:-least] >= enough)
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > least) + 1
    return [(int(i[0] + run[0]), int(i[0] + run[-1]) + least) for run in np.split(starts, cuts)]


def shared_runs(
    a: np.ndarray, b: np.ndarray, least: int, similarity: float, words: tuple[np.ndarray, np.ndarray] | None = None, places: tuple | None = None
) -> list[tuple[int, int]]:
    """Runs of shingles of ``a``, at least ``least`` long, that are similar to a run of
    ``b``: shared over all distinct shingles of both runs. ``words`` of both texts, where
    given, place the ends of a run whose first or last shingles have no match. ``places``:
    :func:`places_of` both, where the caller has many pairs of them."""
    # So many shingles of two runs of the least length must be shared.
    enough = 2 * similarity / (1 + similarity) * least
    (_, _, before_a), (values, first, before_b) = places or (places_of(a), places_of(b))
    at = np.minimum(np.searchsorted(values, a), len(values) - 1)
    match = np.flatnonzero(values[at] == a)
    if len(match) < least * similarity / (1 + similarity):
        return []
    where = first[at[match]]
    cuts = np.flatnonzero(np.diff(match) > NEAR) + 1
    pending, found = [x for x in zip(np.split(match, cuts), np.split(where, cuts))], []
    while pending:
        i, j = pending.pop()
        if not len(i) or i[-1] - i[0] + 1 < least:
            run = _widened(a, b, i, j, least, similarity, words) if len(i) >= enough else None
            if run:
                found.append(run)
            continue
        n = int(i[-1] - i[0]) + 1
        shift = j - i
        aligned = np.abs(shift - _median(shift)) <= SHIFT
        if aligned.any():
            # Equal shingles have one place in b, the first.
            there = j[aligned]
            low, high = int(there.min()), int(there.max()) + 1
            e = int(np.count_nonzero(np.bincount(there - low)))
            own = _n_distinct(before_a, int(i[0]), int(i[-1]) + 1)
            other = _n_distinct(before_b, low, high)
            if e >= similarity * (own + other - e):
                found.append((int(i[0]), int(i[-1]) + 1))
                continue
        # The whole is not similar, but parts of it may be.
        parts = _similar_windows(i[aligned], least, enough)
        if parts:
            found += parts
            part = np.searchsorted([x for run in parts for x in run], i, "right")
            left = np.split(np.arange(len(i)), np.flatnonzero(np.diff(part)) + 1)
            pending += [(i[k], j[k]) for k in left if part[k[0]] % 2 == 0]
            continue
        gaps = np.diff(i)
        if not len(gaps) or gaps.max() == 1:
            # Every shingle stands in b, which repeats parts of it in several places.
            found.append((int(i[0]), int(i[-1]) + 1))
            continue
        cut = int(gaps.argmax()) + 1
        pending += [(i[:cut], j[:cut]), (i[cut:], j[cut:])]
    return sorted(found)


def repeated_spans(docs: DataFrame, passage_words: int = PASSAGE_WORDS, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``text_key, start, end, first_doc_id``: byte ranges of texts that repeat a passage of
    an earlier document; ``text_key`` is the digest of the text. Ranges may overlap.

    Documents are in the order of their ids, null ids last; equal texts count as one.
    Passages that repeat only inside one document are left. Nulls, empty texts and
    texts shorter than a passage have no ranges."""
    rows = text_rows(docs, doc_id, text).where("text is not null").withColumn("tid", F.xxhash64("text"))
    width = passage_words - SHINGLE + 1
    met = kept_table(meetings(rows.select("doc_id", "tid", "text"), width), "passage-meetings")
    pairs = met.where("b is not null").select("a", "b")
    members = met.where("b is null").groupBy("signature", F.col("a").alias("tid")).agg(F.min("place").alias("place"))
    # Every member of a signature of several texts is in a pair.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
    texts = rows.join(wanted, "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"), F.min("doc_id").alias("doc_id"))
    texts = kept_table(texts, "passage-texts")

    def verify(batches):
        for batch in slices(batches, "text_a", "text_b", most=_SLICE):
            sides = []
            for side in ("text_a", "text_b"):
                coded = texts_of(batch, side).dictionary_encode()
                hashes, starts, ends, words = placed_words(coded.dictionary)
                sides.append((*shingles(hashes, words), hashes, starts, ends, words, coded.indices.to_pylist()))
            (va, oa, ha, starts, ends, words, ia), (vb, ob, hb, _, _, words_b, ib) = sides
            own, other = ([places_of(v[lo:hi]) for lo, hi in zip(o[:-1], o[1:])] for v, o in ((va, oa), (vb, ob)))
            rows = []
            for r, (i, j) in enumerate(zip(ia, ib)):
                both = ha[words[i] : words[i + 1]], hb[words_b[j] : words_b[j + 1]]
                for x, y in shared_runs(va[oa[i] : oa[i + 1]], vb[ob[j] : ob[j + 1]], width, similarity, both, (own[i], other[j])):
                    rows.append((r, int(starts[words[i] + x]), int(ends[words[i] + y + SHINGLE - 2]), x, y))
            at = pa.array([r for r, *_ in rows], pa.int64())
            spans = [pa.array([x[c] for x in rows], pa.int64()) for c in (1, 2, 3, 4)]
            columns = [batch.column("key").take(at), *spans[:2], batch.column("doc_b").take(at), batch.column("a").take(at), *spans[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["text_key", "start", "end", "first_doc_id", "a", "from", "to"])

    side = lambda s: texts.select(F.col("tid").alias(s), F.col("text").alias(f"text_{s}"), F.col("doc_id").alias(f"doc_{s}"))
    order = lambda s: F.struct(F.coalesce(f"doc_{s}", F.lit(_LAST)), F.col(s))
    first = lambda s: texts.select(F.col("tid").alias(s), F.col("doc_id").alias(f"doc_{s}"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        # A later copy of an early text must not make that text the later one: the pair is turned.
        both = pairs.join(first("a"), "a").join(first("b"), "b")
        turned = order("a") < order("b")
        pairs = both.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b")).distinct()
        joined = pairs.join(side("a"), "a").join(side("b"), "b").select(F.md5("text_a").alias("key"), "a", "text_a", "text_b", "doc_b")
        return kept_table(joined.mapInArrow(lean(verify), "text_key string, start bigint, end bigint, first_doc_id bigint, a bigint, from bigint, to bigint"), name)

    spans = verified(pairs, "passage-spans")
    more = kept_table(further_pairs(members, spans, texts, width, similarity), "passage-further")
    spans = spans.union(verified(more, "passage-spans-further"))
    return spans.select("text_key", "start", "end", "first_doc_id")


def _ranges(docs: DataFrame, doc_id: str, text: str, **options) -> tuple[DataFrame, DataFrame]:
    """Ranges per text, in one list, and the first id of every text of enough words in
    several rows, all of whose later rows repeat the whole of it."""
    spans = repeated_spans(docs, doc_id=doc_id, text=text, **options)
    lists = spans.groupBy("text_key").agg(F.collect_list(F.struct("start", "end", "first_doc_id")).alias("ranges"))
    copies = text_rows(docs, doc_id, text).where("text is not null").groupBy(F.md5("text").alias("text_key")).agg(
        F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("n")
    )
    return kept_table(lists, "passage-ranges"), copies.where("n > 1").select("text_key", "copy_of")


def _merged(ranges, whole: int | None, copy_of: int | None, data: bytes, least: int) -> list[tuple[int, int, int | None]]:
    """Disjoint ranges in order; of a later copy the whole text if it has a passage's words."""
    if whole is not None:
        _, starts, ends, _ = placed_words(pa.array([data.decode()]))
        return [(int(starts[0]), int(ends[-1]), copy_of)] if len(starts) >= least else []
    out: list[tuple[int, int, int | None]] = []
    for r in sorted(ranges or [], key=lambda r: (r["start"], r["end"])):
        if out and r["start"] <= out[-1][1]:
            ids = [i for i in (out[-1][2], r["first_doc_id"]) if i is not None]
            out[-1] = (out[-1][0], max(out[-1][1], r["end"]), min(ids) if ids else None)
        else:
            out.append((r["start"], r["end"], r["first_doc_id"]))
    return out


def _with_ranges(docs: DataFrame, names: dict[str, str], doc_id: str, text: str, **options) -> DataFrame:
    lists, copies = _ranges(docs, doc_id, text, **options)
    key = names["key"]
    keyed = docs.withColumn(key, F.md5(F.col(text).cast("string")))
    lists = lists.select(F.col("text_key").alias(key), F.col("ranges").alias(names["ranges"]))
    copies = copies.select(F.col("text_key").alias(key), F.col("copy_of").alias(names["copy_of"]), F.lit(True).alias(names["copied"]))
    joined = keyed.join(lists, key, "left").join(copies, key, "left")
    later = F.col(names["copied"]) & ~F.col(doc_id).cast("bigint").eqNullSafe(F.col(names["copy_of"]))
    return joined.withColumn(names["copied"], F.when(later, F.lit(1))).drop(key)


def find_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, span, start, end, n_words, first_doc_id``: every passage, in characters of
    the document's text, that repeats one of the earlier document ``first_doc_id``.
    Overlapping ranges are one. Documents without such a passage have no row."""
    names = {x: x for x in ("key", "ranges", "copy_of", "copied")}
    rows = _with_ranges(text_rows(docs, doc_id, text), names, "doc_id", "text", passage_words=passage_words, similarity=similarity)

    def places(batches):
        for batch in slices(batches, "text"):
            out = []
            texts = texts_of(batch, "text").to_pylist()
            for i, t, r, c, w in zip(batch.column("doc_id").to_pylist(), texts, *(batch.column(x).to_pylist() for x in ("ranges", "copy_of", "copied"))):
                data = t.encode()
                _, starts, _, _ = placed_words(pa.array([t]))
                for n, (lo, hi, first) in enumerate(_merged(r, w, c, data, passage_words)):
                    before = len(data[:lo].decode(errors="ignore"))
                    words = int(np.searchsorted(starts, hi) - np.searchsorted(starts, lo))
                    out.append((i, n, before, before + len(data[lo:hi].decode(errors="ignore")), words, first))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "span", "start", "end", "n_words", "first_doc_id"])

    some = rows.where("ranges is not null or copied is not null")
    return some.mapInArrow(lean(places), "doc_id bigint, span int, start bigint, end bigint, n_words bigint, first_doc_id bigint")


def cut_passages(docs: DataFrame, passage_words: int = PASSAGE_WORDS, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without passages that an earlier document has: the first document keeps
    them. All rows and columns stay; a text that is one passage becomes empty."""
    names = {x: free_name(docs, x) for x in ("key", "ranges", "copy_of", "copied")}
    rows = _with_ranges(docs, names, doc_id, text, passage_words=passage_words, similarity=similarity)
    found = F.col(names["ranges"]).isNotNull() | F.col(names["copied"]).isNotNull()
    order = docs.columns

    def cut(batches):
        for batch in slices(batches, text):
            texts = []
            for t, r, c, w in zip(texts_of(batch, text).to_pylist(), *(batch.column(names[x]).to_pylist() for x in ("ranges", "copy_of", "copied"))):
                data, at, left = t.encode(), 0, []
                for lo, hi, _ in _merged(r, w, c, data, passage_words):
                    left.append(data[at:lo])
                    at = hi
                texts.append(b"".join([*left, data[at:]]).decode(errors="ignore"))
            new = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([new if c == text else batch.column(c) for c in order], order)

    return rows.where(~found).select(*order).union(rows.where(found).mapInArrow(lean(cut), docs.schema))


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"))
