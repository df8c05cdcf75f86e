"""Stateful stream operators: change filter and minimum gap.

Each key keeps one BIGINT of state in RocksDB. A key's rows of a micro-batch may
come in several pieces in any order: a first pass takes the numbers that decide from
every piece, a second gives the rows piece by piece.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marinelake.options import RECORD_GAP_SECONDS

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)

# Helper columns. Names with a leading underscore do not reach the state operator.
_US, _ORDER, _FORCE = "state_time_us", "state_order", "state_force"

#: Bytes of a key's rows that a task keeps in memory; more lie in a local file.
IN_MEMORY = 8 << 20


def order_of(order: str) -> Column:
    """The order column as a number without nulls; rows without an order come last."""
    return F.coalesce(F.col(order).cast("bigint"), F.lit(2**63 - 1).cast("bigint"))


class Pieces:
    """A key's rows of a micro-batch, kept piece by piece for a second pass.

    Beyond ``IN_MEMORY`` bytes they lie in a temporary file of the task, so that it holds
    one piece of Spark's size and, of all rows, only the numbers given with them."""

    def __init__(self):
        self._file, self._places = tempfile.SpooledTemporaryFile(max_size=IN_MEMORY), []

    def add(self, rows: pd.DataFrame, first: int, *numbers: np.ndarray) -> None:
        self._places.append((first, self._file.tell(), numbers))
        pickle.dump(rows, self._file, protocol=pickle.HIGHEST_PROTOCOL)

    def numbers(self) -> list[np.ndarray]:
        """The numbers of all rows, in the order in which the pieces are given."""
        self._places.sort(key=lambda place: place[:2])
        joined = [np.concatenate(parts) for parts in zip(*(numbers for *_, numbers in self._places))]
        self._places = [(*place[:2], ()) for place in self._places]
        return joined

    def __iter__(self) -> Iterator[pd.DataFrame]:
        """The pieces by the order of their first rows."""
        for _, place, _ in sorted(self._places, key=lambda place: place[:2]):
            self._file.seek(place)
            yield pickle.load(self._file)

    def chosen(self, keep: np.ndarray) -> Iterator[pd.DataFrame]:
        """Of every piece the rows to keep."""
        start = 0
        for rows in self:
            part = keep[start : start + len(rows)]
            start += len(rows)
            if part.any():
                yield rows.loc[part]


class _LastValue(StatefulProcessor):
    """Base: one BIGINT per key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "last BIGINT")

    def _read(self) -> int | None:
        return self.last.get()[0] if self.last.exists() else None

    def close(self) -> None:
        pass


class MinGap(_LastValue):
    """Keeps a row when the gap has passed since the last kept one; forced rows always."""

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        pieces = Pieces()
        for piece in rows:
            numbers = [piece[c].to_numpy(t) for c, t in ((_US, np.int64), (_ORDER, np.int64), (_FORCE, bool))]
            pieces.add(piece.drop(columns=[_US, _ORDER, _FORCE]).reset_index(drop=True), int(numbers[0].min()), *numbers)
        times, orders, forced = pieces.numbers()
        last = self._read()
        keep = np.zeros(len(times), bool)
        for i in np.lexsort((orders, times)):
            us = int(times[i])
            if forced[i] or last is None or us - last >= self.gap_us:
                keep[i], last = True, us
        if keep.any():
            self.last.update((last,))
            yield from pieces.chosen(keep)


class Changed(_LastValue):
    """Keeps a row when its time differs from that of the row before."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        pieces = Pieces()
        for piece in rows:
            times, orders = (piece[c].to_numpy(np.int64) for c in (_US, _ORDER))
            pieces.add(piece.drop(columns=[_US, _ORDER, _FORCE]).reset_index(drop=True), int(orders.min()), times, orders)
        times, orders = pieces.numbers()
        place = np.argsort(orders, kind="stable")
        times = times[place]
        last = self._read()
        keep = np.empty(len(times), bool)
        keep[place] = np.concatenate([[last is None or last != int(times[0])], times[1:] != times[:-1]])
        self.last.update((int(times[-1]),))
        yield from pieces.chosen(keep)


def _run(
    stream: DataFrame,
    keys: list[str],
    time: str,
    order: str,
    force: str | None,
    processor: StatefulProcessor,
) -> DataFrame:
    use_rocksdb(stream.sparkSession)
    prepared = stream.where(F.col(time).isNotNull()).withColumns(
        {
            _US: F.unix_micros(F.col(time).cast("timestamp")),
            _ORDER: order_of(order),
            _FORCE: F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False),
        }
    )
    return prepared.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="None",
    )


def stream_min_gap(
    stream: DataFrame,
    keys: list[str],
    time: str = "time",
    order: str = "line_ord",
    gap_seconds: float = RECORD_GAP_SECONDS,
    force: str | None = None,
) -> DataFrame:
    """Streaming form of the minimum-gap downsampling, in arrival order of micro-batches."""
    gap_us = int(max(1, gap_seconds) * 1_000_000)
    return _run(stream, keys, time, order, force, MinGap(gap_us))


def stream_changed(
    stream: DataFrame, keys: list[str], time: str = "time", order: str = "line_ord"
) -> DataFrame:
    """Streaming form of the change filter."""
    return _run(stream, keys, time, order, None, Changed())
