"""Minimum-gap downsampling: keep a record when ``gap`` has passed since the last kept one.

Which record is kept depends on every earlier one, so a key is sequential by
nature. It is still spread over many tasks: time is cut into chunks of many
gaps, and a chunk is summarised by the function that maps "the earliest time a
record may be kept" on entry to the same on exit. That function is a step
function with at most one step per record of the chunk's first gap. Applying the
summaries of a key one after the other gives the entry time of every chunk, and
with it each chunk selects its records on its own.

1. candidates: first record per (key, time), combined map-side;
2. summaries: one small row per (key, chunk);
3. entry times: one pass over the summaries of a key;
4. selection: chunks again, from the shuffle of step 2.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.options import RECORD_GAP_SECONDS

# Gaps per chunk. A summary is smaller than its chunk by at least this factor, and a
# task holds the times of one chunk.
CHUNK_GAPS = 256

_NONE = int(np.iinfo(np.int64).max)
_OPEN = int(np.iinfo(np.int64).min)


def _nodes(
    df: DataFrame, keys: list[str], time: str, order: str, force: str | None, chunk_us: int
) -> DataFrame:
    """Records that can matter: per (key, time) the first unforced one and the forced mark.

    An unforced record that follows a forced one at the same time is never kept.
    ``_chunk`` is the time the chunk starts.
    """
    forced = F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False)
    number = F.col(order).cast("bigint")
    chunk = F.col("_us") - F.pmod(F.col("_us"), F.lit(chunk_us))
    timed = df.where(F.col(time).isNotNull()).select(
        *keys,
        F.unix_micros(F.col(time).cast("timestamp")).alias("_us"),
        F.when(~forced, number).alias("_free"),
        F.when(forced, number).alias("_forced"),
    )
    return (
        timed.groupBy(*keys, chunk.alias("_chunk"), "_us")
        .agg(
            F.coalesce(F.min("_free"), F.lit(_NONE)).alias("_free"),
            F.coalesce(F.min("_forced"), F.lit(_NONE)).alias("_forced"),
        )
        .withColumn(
            "_free", F.when(F.col("_free") < F.col("_forced"), F.col("_free")).otherwise(_NONE)
        )
    )


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group starts; row 0 is always one."""
    changed = np.zeros(len(table), dtype=bool)
    changed[0] = True
    for key in keys:
        column = table[key].combine_chunks()
        here, before = column[1:], column[:-1]
        differs = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
        nullness = pc.not_equal(pc.is_null(here), pc.is_null(before))
        changed[1:] |= differs | nullness.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def _continues(before: pa.Table, table: pa.Table, keys: list[str]) -> bool:
    """Whether the first row of ``table`` belongs to the group of ``before``'s last row."""
    edge = pa.concat_tables([before.slice(len(before) - 1, 1), table.slice(0, 1)])
    return len(_starts(edge.select(keys), keys)) == 1


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by ``keys``, across Arrow batches.

    Several groups are handed on together; none is ever cut.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held and not _continues(held[-1], table, keys):
            yield pa.concat_tables(held)
            held = []
        last_start = int(_starts(table, keys)[-1])
        if last_start > 0:
            yield pa.concat_tables([*held, table.slice(0, last_start)])
            held = []
        held.append(table.slice(last_start))
    if held:
        yield pa.concat_tables(held)


def _int64(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


class _Chunk:
    """The records of one (key, chunk) as an ordered list of nodes.

    At one time an unforced node comes before a forced one.
    """

    def __init__(self, us: np.ndarray, free: np.ndarray, forced: np.ndarray, gap: int):
        has_free, has_forced = free != _NONE, forced != _NONE
        where = np.concatenate([np.flatnonzero(has_free), np.flatnonzero(has_forced)])
        is_forced = np.concatenate(
            [np.zeros(has_free.sum(), dtype=bool), np.ones(has_forced.sum(), dtype=bool)]
        )
        nodes = np.lexsort((is_forced, where))
        self.gap = gap
        self.where = where[nodes]
        self.forced = is_forced[nodes]
        self.us = us[self.where]
        self.n = len(self.us)
        # First forced node at or after each position; n where there is none.
        at = np.where(self.forced, np.arange(self.n), self.n)
        self.next_forced = np.append(np.minimum.accumulate(at[::-1])[::-1], self.n)
        after_gap = np.searchsorted(self.us, self.us + gap, side="left")
        self.following = np.append(
            np.minimum(after_gap, self.next_forced[1:]), self.n
        )

    def last_nodes(self) -> np.ndarray:
        """For each node, the last node kept when it is kept."""
        last = np.append(np.arange(self.n), self.n)
        last[:-1] = np.where(self.following[:-1] < self.n, self.following[:-1], last[:-1])
        while True:
            further = last[last]
            if np.array_equal(further, last):
                return last
            last = further

    def steps(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The chunk's step function for entry times before ``limit``."""
        reach = min(int(np.searchsorted(self.us, limit, side="left")) + 1, self.n)
        first = np.minimum(np.arange(reach), self.next_forced[0])
        upto, last = self.us[:reach], self.last_nodes()
        if self.next_forced[0] < self.n:
            # Whatever the entry time, a forced node is kept.
            first = np.append(first, self.next_forced[0])
            upto = np.append(upto, _NONE)
        leave = self.us[last[first]] + self.gap
        ends = np.append(np.flatnonzero(np.diff(leave)), len(leave) - 1)
        return upto[ends], leave[ends]

    def kept_rows(self, allowed: int) -> np.ndarray:
        """Rows of the unforced nodes kept when records may be kept from ``allowed`` on."""
        start = min(
            int(np.searchsorted(self.us, allowed, side="left")), int(self.next_forced[0])
        )
        if start >= self.n:
            return np.empty(0, dtype=np.int64)
        seen = np.zeros(self.n + 1, dtype=bool)
        seen[start] = True
        jump = self.following
        while True:
            # ``jump`` goes 2**k nodes on, and ``seen`` holds the first 2**k kept ones.
            seen[jump[seen]] = True
            if jump[start] == self.n:
                break
            jump = jump[jump]
        return self.where[seen[: self.n] & ~self.forced]


def _chunks(table: pa.Table, keys: list[str], gap: int) -> Iterator[tuple[int, _Chunk]]:
    """The chunks of a table of whole groups, each with its first row number."""
    starts = _starts(table, [*keys, "_chunk"])
    us, free, forced = (_int64(table, name) for name in ("_us", "_free", "_forced"))
    for low, high in zip(starts, np.append(starts[1:], len(table))):
        yield int(low), _Chunk(us[low:high], free[low:high], forced[low:high], gap)


def _summarise(keys: list[str], gap: int) -> Callable:
    """Chunks to step functions: entry times up to ``_upto[i]`` leave with ``_leave[i]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, [*keys, "_chunk"]):
            chunk_start = _int64(table, "_chunk")
            rows, upto, leave = [], [], []
            for low, chunk in _chunks(table, keys, gap):
                # A record kept before the chunk holds off others for one gap at most.
                steps = chunk.steps(int(chunk_start[low]) + gap)
                rows.append(low)
                upto.append(steps[0])
                leave.append(steps[1])
            offsets = np.cumsum([0, *map(len, upto)])
            yield from (
                table.select([*keys, "_chunk"])
                .take(rows)
                .append_column("_upto", pa.ListArray.from_arrays(offsets, np.concatenate(upto)))
                .append_column("_leave", pa.ListArray.from_arrays(offsets, np.concatenate(leave)))
                .to_batches()
            )

    return run


def _walk(keys: list[str]) -> Callable:
    """Summaries of each key in chunk order to the entry time of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, allowed = None, _OPEN
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            fresh = set(_starts(table, keys).tolist())
            if before is not None and _continues(before, table, keys):
                fresh.discard(0)
            ends, upto = _lists(batch, "_upto")
            _, leave = _lists(batch, "_leave")
            entry = np.empty(len(table), dtype=np.int64)
            for row in range(len(table)):
                if row in fresh:
                    allowed = _OPEN
                entry[row] = allowed
                low, high = ends[row], ends[row + 1]
                step = low + int(np.searchsorted(upto[low:high], allowed, side="left"))
                if step < high:
                    allowed = int(leave[step])
            before = table
            out = table.select([*keys, "_chunk"]).append_column("_entry", pa.array(entry))
            yield from out.to_batches()

    return run


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a list column."""
    column = batch.column(name)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.cumsum([0, *sizes]), column.flatten().to_numpy()


def _select(keys: list[str], gap: int) -> Callable:
    """Chunks with their entry time to the unforced records they keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, [*keys, "_chunk"]):
            entry = _int64(table, "_entry")
            rows = [
                low + chunk.kept_rows(int(entry[low])) for low, chunk in _chunks(table, keys, gap)
            ]
            out = table.select([*keys, "_us", "_free"]).take(np.sort(np.concatenate(rows)))
            yield from out.rename_columns([*keys, "_us", "_order"]).to_batches()

    return run


def _typed(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def kept_records(
    df: DataFrame,
    keys: list[str],
    time: str = "time",
    order: str = "line_ord",
    gap_seconds: float = RECORD_GAP_SECONDS,
    force: str | None = None,
    chunk_gaps: int = CHUNK_GAPS,
) -> DataFrame:
    """Keys, time and order of the unforced records that are kept.

    ``order`` is a BIGINT, unique among the records of a key at one time. The gap
    is at least one second.
    """
    gap = int(max(1, gap_seconds) * 1_000_000)
    chunk_us = gap * chunk_gaps
    chunked = _nodes(df, keys, time, order, force, chunk_us).repartition(*keys, "_chunk")
    key_types = _typed(df, keys)
    ordered = chunked.sortWithinPartitions(*keys, "_chunk", "_us")
    summaries = ordered.mapInArrow(
        _summarise(keys, gap),
        f"{key_types}, _chunk BIGINT, _upto ARRAY<BIGINT>, _leave ARRAY<BIGINT>",
    )
    entries = (
        summaries.repartition(*keys)
        .sortWithinPartitions(*keys, "_chunk")
        .mapInArrow(_walk(keys), f"{key_types}, _chunk BIGINT, _entry BIGINT")
    )
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "_chunk"]]
    entered = (
        chunked.alias("c")
        .join(entries.alias("e"), on, "inner")
        .select("c.*", "e._entry")
        .sortWithinPartitions(*keys, "_chunk", "_us")
    )
    kept = entered.mapInArrow(_select(keys, gap), f"{key_types}, _us BIGINT, _order BIGINT")
    return kept.select(
        *keys,
        F.timestamp_micros("_us").cast(df.schema[time].dataType).alias(time),
        F.col("_order").cast(df.schema[order].dataType).alias(order),
    )


def _is_forced(force: str) -> Column:
    return F.coalesce(F.col(force), F.lit(False))


def downsample_min_gap(
    df: DataFrame,
    keys: list[str],
    time: str = "time",
    order: str = "line_ord",
    gap_seconds: float = RECORD_GAP_SECONDS,
    force: str | None = None,
    chunk_gaps: int = CHUNK_GAPS,
) -> DataFrame:
    """Whole rows that are kept; forced rows always are and restart the gap.

    When ``df`` has no column beside the keys, time and order, the selection is
    the result and no join back is needed.
    """
    narrow = [*keys, time, order]
    kept = kept_records(df, keys, time, order, gap_seconds, force, chunk_gaps)
    if force is None and set(df.columns) == set(narrow):
        return kept.select(*df.columns)
    free = df.where(~_is_forced(force)) if force else df
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in narrow]
    chosen = free.alias("r").join(kept.alias("k"), on, "left_semi")
    return chosen.unionByName(df.where(_is_forced(force))) if force else chosen


def throttle_stats(records: DataFrame, sent: DataFrame, keys: list[str]) -> DataFrame:
    """Sent and suppressed counts per key, from the input and the kept records."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    seen = records.select(*keys, one.alias("_in"), zero.alias("_out"))
    kept = sent.select(*keys, zero.alias("_in"), one.alias("_out"))
    return (
        seen.unionByName(kept)
        .groupBy(*keys)
        .agg(
            F.sum("_out").alias("records_sent"),
            (F.sum("_in") - F.sum("_out")).alias("records_suppressed"),
        )
    )
