"""Best-fit packing by linear grouping.

Which documents share a length does not matter to a packing, so the plan is made
on the histogram of lengths, which has at most as many rows as a sequence has
tokens. Large lengths are rounded up within groups of equal cardinality, the
configurations of these few sizes are optimised by column generation, actual
documents take the places of the rounded ones, and what is left is put in by best
fit. The plan is a list of runs of documents of one length; Spark numbers the
documents of each length and looks their runs up.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import kept_table, lean, slices, text_rows, texts_of
from marinelake.llm.registry import query, table
from marinelake.llm.tokens import ByteLevel, public_tokenizer

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
CAPACITY = 2048
#: Lengths above capacity / LARGE_SHARE are large.
LARGE_SHARE = 12
#: Numbers of groups that are tried; the plan with the fewest sequences is taken.
GROUPS = (24, 48)
#: A sequence with more than capacity / share free tokens after the substitution is
#: dissolved, its documents go to best fit. All combinations are tried as well.
LOOSE_SHARES = (1, 128, 1024)


class _Packer:
    """Sequences with the same content so far are one entry: first number and count by gap."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        #: length, first ordinal, count, first sequence, per sequence, offset
        self.runs: list[tuple[int, int, int, int, int, int]] = []

    def open(self, n: int) -> tuple[int, int]:
        self.sequences += n
        return self.sequences - n, n

    def put(self, length: int, ordinal: int, count: int, first: int, per: int, gap: int) -> None:
        self.runs.append((length, ordinal, count, first, per, self.capacity - gap))

    def best_fit(self, length: int, ordinal: int, count: int) -> None:
        """Each document goes where it leaves the least room; equal steps are taken together."""
        while count:
            gap = min((g for g, own in self.gaps.items() if own and g >= length), default=0)
            if gap:
                first, n = self.gaps[gap].pop()
            else:
                gap = self.capacity
                first, n = self.open(max(1, count // (gap // length)))
            per = min(gap // length, count)
            used = min(n, count // per)
            self.put(length, ordinal, used * per, first, per, gap)
            ordinal, count = ordinal + used * per, count - used * per
            if per * length < gap:
                self.gaps[gap - per * length].append((first, used))
            if n > used:
                self.gaps[gap].append((first + used, n - used))


def _configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of the sizes with whole multiplicities, from the linear
    programme's solution rounded down. Columns come from a bounded knapsack."""
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    most = int(capacity // sizes.min())
    for _ in range(40 * k):
        prices = np.linalg.solve(columns.T, np.ones(k))
        value, choice = np.zeros(capacity + 1), []
        for _ in range(most):  # one more item each time
            options = np.full((k, capacity + 1), -1.0)
            for g, s in enumerate(sizes):
                options[g, s:] = value[: capacity + 1 - s] + prices[g]
            best = options.argmax(axis=0)
            grown = options[best, np.arange(capacity + 1)]
            better = grown > value + 1e-12
            if not better.any():
                break
            choice.append(np.where(better, best, -1))
            value = np.where(better, grown, value)
        if value[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(k), capacity
        for step in reversed(choice):
            if step[room] >= 0:
                column[step[room]] += 1
                room -= sizes[step[room]]
        levels, direction = np.linalg.solve(columns, demand), np.linalg.solve(columns, column)
        ratio = np.where(direction > 1e-9, np.maximum(levels, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        columns[:, int(ratio.argmin())] = column
    levels = np.maximum(np.linalg.solve(columns, demand), 0)
    return [(columns[:, i].astype(int), int(levels[i] + 1e-9)) for i in range(k) if levels[i] >= 1 - 1e-9]


def _plan(counts: dict[int, int], capacity: int, groups: int, loose: int) -> _Packer:
    packer = _Packer(capacity)
    used = dict.fromkeys(counts, 0)  # documents of a length in configurations so far
    back: dict[int, list[tuple[int, int]]] = defaultdict(list)  # ordinal, count: given back
    large = sorted((x for x in counts if capacity // LARGE_SHARE < x < capacity), reverse=True)
    total = sum(counts[x] for x in large)
    if large:
        size = room = max(1, -(-total // groups))
        queues: list[list[list[int]]] = [[]]  # of each group: length, count; descending
        for length in large:
            n = counts[length]
            while n:
                if not room:
                    queues.append([])
                    room = size
                taken = min(n, room)
                queues[-1].append([length, taken])
                n, room = n - taken, room - taken
        merged: dict[int, list] = {}
        for q in queues:
            merged.setdefault(q[0][0], []).extend(q)
        sizes = np.array(sorted(merged, reverse=True))
        queues = [merged[s] for s in sizes]
        demand = np.array([sum(n for _, n in q) for q in queues], float)
        for config, times in _configurations(sizes, demand, capacity):
            for placed, n, gap in _substitute(capacity, used, queues, config, times):
                if gap > loose:
                    for length, ordinal in placed:
                        back[length].append((ordinal, n))
                    continue
                first, at = packer.open(n)[0], capacity
                for length, ordinal in placed:
                    packer.put(length, ordinal, n, first, 1, at)
                    at -= length
                if gap:
                    packer.gaps[gap].append((first, n))
    for length in sorted(counts, reverse=True):
        for ordinal, n in [*back[length], (used[length], counts[length] - used[length])]:
            packer.best_fit(length, ordinal, n)
    return packer


def _substitute(capacity: int, used: dict, queues: list, config: np.ndarray, times: int) -> list:
    """Actual documents in the places of the rounded ones of ``times`` sequences:
    entries of (length, first ordinal) pairs, how many sequences, and their gap."""
    entries = [([], times, capacity)]
    for group in np.repeat(np.arange(len(config)), config):
        filled = []
        for placed, n, gap in entries:
            while n and queues[group]:
                length, there = queues[group][0]
                taken = min(n, there)
                # A split entry hands the later documents of each run to its second part.
                filled.append(([*placed, (length, used[length])], taken, gap - length))
                placed = [(x, ordinal + taken) for x, ordinal in placed]
                used[length] += taken
                queues[group][0][1] -= taken
                if taken == there:
                    queues[group].pop(0)
                n -= taken
            if n:
                filled.append((placed, n, gap))
        entries = filled
    return [e for e in entries if e[0]]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs ``(length, first ordinal, count, first sequence, per sequence, offset)``
    sorted by length and ordinal, and the number of sequences."""
    counts = {int(x): int(n) for x, n in counts.items() if n}
    tried = [(g, capacity // part) for g in GROUPS for part in LOOSE_SHARES]
    best = min((_plan(counts, capacity, *t) for t in tried), key=lambda p: p.sequences)
    runs = np.array(sorted(best.runs), np.int64).reshape(-1, 6)
    return runs, best.sequences


def cut_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and
    ``part, nth``, the piece's number among those of its length in its task.

    A document is its ids and the end id; a longer one than ``capacity`` is cut so
    that the first piece is the shorter. A null text is empty: one piece of one id."""

    def cut(batches):
        encoder, part, seen = ByteLevel(public_tokenizer(tokenizer)), TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches, "text"):
            ids, offsets = encoder.encode(texts_of(batch, "text"))
            data = memoryview(ids.astype("<u4").tobytes())
            names, rows = batch.column("doc_id").to_pylist(), []
            for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                n, start, piece = hi - lo + 1, 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    stop = start + length
                    crc = zlib.crc32(data[4 * (lo + start) : 4 * (lo + min(stop, n - 1))])
                    if stop == n:
                        crc = zlib.crc32(END_ID.to_bytes(4, "little"), crc)
                    rows.append((names[i], piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
                    start, piece = stop, piece + 1
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return text_rows(docs, doc_id, text).mapInArrow(
        lean(cut), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length, part, nth``; lengths 1 to ``capacity``) with their
    ``sequence_id`` and ``offset``. An empty table stays empty.

    The pieces are written first, so that ``part`` and ``nth`` stay what they are if
    a task is run again. The driver sees the histogram only."""
    pieces = kept_table(pieces, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    runs, _ = plan_packing({r["length"]: r["n"] for r in histogram}, capacity)
    # Bounded by the number of lengths and configurations, not by the documents.
    shared = pieces.sparkSession.sparkContext.broadcast(runs)
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    schema = pieces.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        runs = shared.value
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            ordinal = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            run = runs[np.searchsorted(keys, length << 48 | ordinal, "right") - 1]
            inside = ordinal - run[:, 1]
            sequence = run[:, 3] + inside // run[:, 4]
            offset = run[:, 5] + inside % run[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return pieces.join(base, ["part", "length"]).select(*kept, "nth", "base").mapInArrow(lean(place), schema)


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all rows of ``docs``; see :func:`cut_documents` and :func:`pack`."""
    return pack(cut_documents(docs, tokenizer, capacity), capacity)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
