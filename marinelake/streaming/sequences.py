"""Stateful operators over the lines and records of a live stream, one state per key.

Rows of a key are sequential by nature: one task works on a key in a micro-batch. It takes
them piece by piece, holds the header and preamble lines and a number or two per row, and
gives the rows in a second pass. Rows that must wait are kept in state as Arrow chunks;
loops run over header and preamble lines or over closed batches, never over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, StructType

from marinelake.functions.lines import classify_cast_line
from marinelake.functions.values import is_blank
from marinelake.options import BATCH_MAX_RECORDS, BATCH_SECONDS
from marinelake.streaming.state import Pieces, order_of, use_rocksdb

# Helper columns. Names with a leading underscore do not reach the state operator.
_ORDER, _MARK, _US, _KEY, _GROUP = "state_order", "state_mark", "state_time_us", "state_key", "state_group"

#: Groups that the keys of count-or-time batches are dealt to by hash: the state, and the
#: calls to it, are per group. It goes with the checkpoint and may not change under it.
STATE_GROUPS = 512


def packed(rows: pd.DataFrame) -> bytes:
    """Rows as one Arrow chunk."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(chunks: list[bytes]) -> pd.DataFrame:
    return pd.concat([pa.ipc.open_stream(c).read_pandas() for c in chunks], ignore_index=True)


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(_ORDER, kind="stable", ignore_index=True)


class _Chunks(StatefulProcessor):
    """Base: rows that wait, as chunks of a list state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("held", "rows BINARY")

    def held(self) -> list[pd.DataFrame]:
        chunks = [bytes(c[0]) for c in self.chunks.get()] if self.chunks.exists() else []
        return [unpacked(chunks)] if chunks else []

    def close(self) -> None:
        pass


class HeaderInForce(_Chunks):
    """Gives every line the header before it; lines before the first header wait for it.

    However many they are, all wait, as chunks of a map state: an entry per piece, found by
    the number of lines before it, since a list state is one value of the store and is read
    whole. Only with ``most`` do they wait in the list state; more lines than that all go
    on without a header."""

    def __init__(self, value: str, columns: list[str], most: int | None = None):
        self.value, self.columns, self.most = value, columns, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("header", "header STRING, held BIGINT")
        if self.most is None:
            self.parts = handle.getMapState("waiting", "before BIGINT", "rows BINARY")

    def _wait(self, lines: pd.DataFrame, before: int) -> None:
        chunk = (packed(lines),)
        if self.most is None:
            self.parts.updateValue((before,), chunk)
        else:
            self.chunks.appendValue(chunk)

    def _waited(self, count: int) -> Iterator[pd.DataFrame]:
        """The lines that wait, chunk by chunk; they wait no longer. Those of the list state
        come first: also without a limit, if a checkpoint is from a time with one."""
        done = 0
        if count and self.chunks.exists():
            for chunk in self.chunks.get():
                lines = unpacked([bytes(chunk[0])])
                done += len(lines)
                yield lines
            self.chunks.clear()
        while done < count:
            lines = unpacked([bytes(self.parts.getValue((done,))[0])])
            self.parts.removeKey((done,))
            done += len(lines)
            yield lines

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pieces, found, count = Pieces(), [], 0
        for piece in rows:
            marked = piece[_MARK].to_numpy(bool)
            found.append(piece.loc[marked, [_ORDER, self.value]])
            lines = _in_order(piece.loc[~marked, [*self.columns, _ORDER]])
            if len(lines):
                pieces.add(lines, int(lines[_ORDER].iat[0]))
                count += len(lines)
        header, waiting = self.state.get() if self.state.exists() else (None, 0)
        heads = _in_order(pd.concat(found, ignore_index=True))
        places, values = heads[_ORDER].to_numpy(np.int64), heads[self.value].to_numpy(object)
        last = values[-1] if len(values) else header
        if last is None and (self.most is None or waiting + count <= self.most):
            for lines in pieces:
                self._wait(lines[self.columns], waiting)
                waiting += len(lines)
            self.state.update((None, waiting))
            return
        # Lines before the first header of all take that one.
        before = header if header is not None or not len(values) else values[0]
        for lines in self._waited(waiting):
            yield lines.assign(header=before)
        self.state.update((last, 0))
        in_force = np.array([before, *values], object)
        for lines in pieces:
            at = np.searchsorted(places, lines[_ORDER].to_numpy(np.int64), "right")
            yield lines[self.columns].assign(header=in_force[at])


class Preamble(StatefulProcessor):
    """Gathers the header and calibration lines of a scan stream into numbered documents
    and gives every scan its number and that of the document in force."""

    def __init__(self, value: str, columns: list[str]):
        self.value, self.columns = value, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "version BIGINT, scans BIGINT, open BOOLEAN, inside BOOLEAN, ended BOOLEAN")
        self.texts = handle.getValueState("texts", "header STRING, xmlcon STRING")

    def _apply(self, role: str, line: str) -> bool:
        """Take in one preamble line; whether the documents changed."""
        if role == "xmlcon_start":
            self.inside, self.xmlcon = True, ""
        elif role == "xmlcon_end":
            self.inside = False
        elif self.inside:
            self.xmlcon += (line[2:] if line.startswith("# ") else line[1:]) + "\n"
            return True
        elif role == "header_end":
            self.ended = True
        elif not self.ended:
            self.header += line + "\n"
            return True
        return False

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pieces, told, first = Pieces(), [], None
        for piece in rows:
            piece = _in_order(piece)
            if first is None or piece[_ORDER].iat[0] < first[_ORDER].iat[0]:
                first = piece.iloc[:1]
            roles = piece[_MARK].to_numpy(object)
            is_scan = roles == "scan"
            is_told = ~is_scan & (roles != "ignore")
            told.append(piece.loc[is_told, [_ORDER, _MARK, self.value]])
            others = piece.loc[~is_told, [*self.columns, _MARK]].reset_index(drop=True)
            pieces.add(others, int(piece[_ORDER].iat[0]), piece.loc[is_scan, _ORDER].to_numpy(np.int64))
        version, scans, dirty, self.inside, self.ended = self.at.get() if self.at.exists() else (0, 0, False, False, False)
        self.header, self.xmlcon = self.texts.get() if self.texts.exists() else ("", "")
        (orders,) = pieces.numbers()
        sorting = np.argsort(orders, kind="stable")
        orders = orders[sorting]
        # The place of every scan among the scans of the micro-batch, in the order of the pieces.
        rank = np.empty(len(sorting), np.int64)
        rank[sorting] = np.arange(len(sorting))
        del sorting
        starts, versions, documents, changed = [], [], [], False

        def settle(start: int, stop: int) -> None:
            """Scans ``start`` to ``stop`` follow what was gathered so far."""
            nonlocal version, dirty
            if start < stop:
                if dirty:
                    version, dirty = version + 1, False
                    documents.append((version, self.header, self.xmlcon))
                starts.append(start)
                versions.append(version)

        done = 0
        for order, role, line in _in_order(pd.concat(told, ignore_index=True)).itertuples(index=False):
            here = int(np.searchsorted(orders, order))
            settle(done, here)
            done = here
            if self._apply(role, line.strip()):
                dirty = changed = True
        settle(done, len(orders))
        self.at.update((version, scans + len(orders), dirty, self.inside, self.ended))
        if changed:
            self.texts.update((self.header, self.xmlcon))
        del orders

        starts, versions, done = np.array(starts, np.int64), np.array(versions, np.int64), 0
        for piece in pieces:
            roles = piece[_MARK].to_numpy(object)
            noise = piece.loc[roles == "ignore", self.columns].assign(role="ignore", version=np.int64(version), scan=None, header=None, xmlcon=None)
            found = piece.loc[roles == "scan", self.columns]
            if len(noise):
                yield noise
            if len(found):
                at = rank[done : done + len(found)]
                done += len(found)
                number = versions[np.searchsorted(starts, at, "right") - 1]
                yield found.assign(role="scan", version=number, scan=scans + 1 + at, header=None, xmlcon=None)
        if documents:
            # A document's row has the place of the micro-batch's first line and no value.
            numbers, headers, xmlcons = (list(x) for x in zip(*documents))
            yield first.loc[[first.index[0]] * len(documents), self.columns].assign(
                **{self.value: None}, role="preamble", version=numbers, scan=None, header=headers, xmlcon=xmlcons
            )

    def close(self) -> None:
        pass


class CountOrTime(_Chunks):
    """Closes a batch of a key's records when it is full or when its time is over.

    Records wait until the watermark has passed them, so that they are taken in order of
    time however they arrived. A batch opens with its first record and closes with the
    ``most``-th, or as the first record at or after its end is taken or the watermark
    passes the end. The state is that of a group of keys, told apart by the column ``key``;
    without one all records are of one key."""

    def __init__(self, columns: list[str], span_us: int, most: int, key: str | None = None):
        self.columns, self.span_us, self.most, self.key = columns, span_us, most, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.numbers = handle.getValueState("numbers", "rows BINARY")  # a key and its last number
        self.wake = handle.getValueState("wake", "ms BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Spark drops rows behind the watermark before this operator sees them.
        earliest = []
        for piece in rows:
            self.chunks.appendValue((packed(piece),))
            earliest.append(int(piece[_US].min()))
        # No batch closes before the watermark has passed its first record.
        self._wake(min(earliest) + 1)
        return iter(())

    def _wake(self, us: int) -> None:
        """Call again once the watermark has reached a time, unless a call before is due.
        One timer is enough: each call sets the next."""
        ms = -(-us // 1000)  # rounded up to a millisecond
        if not self.wake.exists() or ms < self.wake.get()[0]:
            self.wake.update((ms,))
            self.handle.registerTimer(ms)

    def _cut(self, times: np.ndarray, first: np.ndarray, stop: np.ndarray, passed: int) -> tuple[pd.DataFrame, int | None]:
        """The closed batches of keys whose sorted times lie from ``first`` to ``stop``:
        their key, place among the key's, rows and whether they are full; and the time at
        which the next one closes if no more records come. One step is a batch of every key."""
        key, start, place, closed, nexts = np.arange(len(first)), first, 0, [], []
        while len(key):
            end = times[start] + self.span_us
            low, high = start, np.minimum(start + self.most, stop[key])
            while (wide := low < high).any():  # the first record at or after the end, by halves
                middle = (low + high) // 2
                inside = wide & (times[np.minimum(middle, len(times) - 1)] < end)
                low, high = np.where(inside, middle + 1, low), np.where(wide & ~inside, middle, high)
            full = low - start == self.most
            closes = np.where(full, times[low - 1] + 1, end)
            over = closes <= passed
            nexts.append(closes[~over])
            place += 1
            closed.append(pd.DataFrame({"key": key[over], "place": place, "start": start[over], "stop": low[over], "full": full[over]}))
            more = over & (low < stop[key])
            key, start = key[more], low[more]
        nexts = np.concatenate(nexts)
        return pd.concat(closed).sort_values("start", ignore_index=True), int(nexts.min()) if len(nexts) else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        if self.wake.exists() and self.wake.get()[0] > mark:
            return  # an earlier timer of this micro-batch has done it
        self.wake.clear()
        held = self.held()
        if not held:
            return
        codes, keys = pd.factorize(held[0][self.key]) if self.key else (np.zeros(len(held[0]), np.int64), np.array([""], object))
        order = np.lexsort((held[0][_ORDER], held[0][_US], codes))
        rows, codes = held[0].iloc[order], codes[order]
        first = np.searchsorted(codes, np.arange(len(keys)))
        closed, wakes = self._cut(rows[_US].to_numpy(np.int64), first, np.append(first[1:], len(rows)), mark * 1000)
        if wakes is not None:
            self._wake(wakes)
        if not len(closed):
            return
        known = unpacked([bytes(self.numbers.get()[0])]).set_index("key")["number"] if self.numbers.exists() else pd.Series([], dtype="int64")
        before = known.reindex(keys, fill_value=0).to_numpy(np.int64)
        after = before + np.bincount(closed["key"], minlength=len(keys))
        now = pd.concat([known[~known.index.isin(keys)], pd.Series(after, index=keys)])
        self.numbers.update((packed(pd.DataFrame({"key": now.index.to_numpy(object), "number": now.to_numpy(np.int64)})),))

        start, size = closed["start"].to_numpy(), (closed["stop"] - closed["start"]).to_numpy()
        batch = np.repeat(np.arange(len(closed)), size)
        taken = np.arange(len(batch)) + (start - np.cumsum(size) + size)[batch]
        rest = np.ones(len(rows), bool)
        rest[taken] = False
        self.chunks.clear()
        if rest.any():
            self.chunks.appendValue((packed(rows[rest]),))
        number = before[closed["key"]] + closed["place"].to_numpy()
        yield rows.iloc[taken][self.columns].assign(
            batch_no=number[batch], closed_by=np.where(closed["full"], "count", "time")[batch], batch_start_us=rows[_US].to_numpy(np.int64)[start][batch]
        )


def _schema(stream: DataFrame, extra: str) -> StructType:
    return StructType([*stream.schema.fields, *StructType.fromDDL(extra).fields])


def stream_with_headers(lines: DataFrame, keys: list[str], header: Column, order: str = "line_ord", value: str = "value", most: int | None = None) -> DataFrame:
    """Every line of a stream with the ``header`` line in force, across micro-batches.

    ``header`` says which lines are headers; they themselves, blank lines and comments
    are not passed on. A new header holds from its place on. Lines that come before the
    first header of their key all wait for it, in the state store. With ``most``, once more
    than that wait, they are passed on with a null header; a checkpoint that began without
    it goes on without it."""
    use_rocksdb(lines.sparkSession)
    usable = ~is_blank(F.col(value)) & ~F.ltrim(value).startswith("#")
    marked = lines.where(usable).withColumns({_ORDER: order_of(order), _MARK: F.coalesce(header, F.lit(False))})
    return marked.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=HeaderInForce(value, lines.columns, most),
        outputStructType=_schema(lines, "header STRING"),
        outputMode="Append",
        timeMode="None",
    )


def stream_scans(lines: DataFrame, keys: list[str], order: str = "line_ord", value: str = "value") -> DataFrame:
    """Scans of a stream that carries its own preamble, and the preamble itself.

    Adds ``role`` (``scan``, ``preamble`` or ``ignore``), ``version``, ``scan``, ``header``
    and ``xmlcon``. Scans are numbered from 1 on and name the version of the preamble
    before them, 0 where there is none; every version is one row with both documents. A
    new calibration block replaces the one before; header lines after the end of the
    header are passed over."""
    use_rocksdb(lines.sparkSession)
    marked = lines.withColumns({_ORDER: order_of(order), _MARK: classify_cast_line(F.col(value))})
    return marked.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Preamble(value, lines.columns),
        outputStructType=_schema(lines, "role STRING, version BIGINT, scan BIGINT, header STRING, xmlcon STRING"),
        outputMode="Append",
        timeMode="None",
    )


def stream_batches(
    records: DataFrame, keys: list[str], time: str = "time", order: str = "line_ord", seconds: float = BATCH_SECONDS,
    max_records: int = BATCH_MAX_RECORDS, watermark: str = "10 minutes", groups: int = STATE_GROUPS,
) -> DataFrame:
    """Batches of a key's records, closed by count or by time, whichever is first.

    Adds ``batch_no`` (from 1), ``batch_start`` and ``closed_by``; a batch is emitted when
    it closes. Time is that of the records, and they are taken in its order: the result
    does not depend on the micro-batches, as long as no record is behind the watermark.
    Records without a time are in no batch. A key holds the records of the watermark's
    delay and of one open batch, and a task those of a group of keys."""
    use_rocksdb(records.sparkSession)
    # Whole numbers without nulls: pandas would make doubles of those of a whole group.
    whole = {
        f.name: f"state_null_{i}" for i, f in enumerate(records.schema.fields) if isinstance(f.dataType, IntegralType) and f.nullable
    }
    named = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    # The watermark is on a column of its own, which is not passed on.
    timed = records.where(F.col(time).isNotNull()).withColumns(
        {
            "state_time": F.col(time).cast("timestamp"),
            _US: F.unix_micros(F.col(time).cast("timestamp")),
            _ORDER: order_of(order),
            _KEY: named,
            _GROUP: F.pmod(F.xxhash64(named), F.lit(groups)),
            **{flag: F.col(c).isNull() for c, flag in whole.items()},
            **{c: F.coalesce(F.col(c), F.lit(0).cast(records.schema[c].dataType)) for c in whole},
        }
    )
    passed = [*records.columns, *whole.values()]
    batches = timed.withWatermark("state_time", watermark).groupBy(_GROUP).transformWithStateInPandas(
        statefulProcessor=CountOrTime(passed, int(seconds * 1_000_000), max_records, _KEY),
        outputStructType=_schema(timed.select(*passed), "batch_no BIGINT, closed_by STRING, batch_start_us BIGINT"),
        outputMode="Append",
        timeMode="EventTime",
    )
    restored = batches.withColumns({c: F.when(~F.col(flag), F.col(c)) for c, flag in whole.items()}).drop(*whole.values())
    return restored.withColumn("batch_start", F.timestamp_micros("batch_start_us")).drop("batch_start_us")
