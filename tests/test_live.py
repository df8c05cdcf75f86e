"""Live streams: published micro-batches, and the state operators on hand-made pieces."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marinelake.options import JobOptions, ProviderRule
from marinelake.plans.stream_ingest import sentence_batches, window_batches
from marinelake.storage import names_below, path_exists, read_small, write_new
from marinelake.streaming.commits import Commits, published_table
from marinelake.streaming.sequences import CountOrTime, HeaderInForce, Preamble, packed, unpacked


class Store:
    """What a state operator sees of one key: value and list states, and timers."""

    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    getListState = getValueState

    def registerTimer(self, ms):
        self.timers.add(ms)


class Value:
    def __init__(self):
        self.value, self.list = None, []

    def exists(self):
        return self.value is not None or bool(self.list)

    def get(self):
        return iter(self.list) if self.list else self.value

    def update(self, value):
        self.value = value

    def appendValue(self, value):
        self.list.append(value)

    def clear(self):
        self.value, self.list = None, []


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def fed(processor, pieces, **more):
    """The rows a processor gives for micro-batches that come in several pieces."""
    processor.init(Store())
    out = []
    for rows in pieces:
        cut = max(1, len(rows) // 2)
        frames = [pd.DataFrame(rows[i : i + cut]) for i in range(0, len(rows), cut)]
        out.append([r for part in processor.handleInputRows(("k",), iter(frames[::-1]), None) for r in part.to_dict("records")])
    return out


def csv(*lines):
    return [{"source_file": "k", "line_ord": i, "value": v, "state_order": i, "state_mark": v.startswith("time")} for i, v in lines]


def test_lines_wait_for_their_header():
    columns = ["source_file", "line_ord", "value"]
    got = fed(HeaderInForce("value", columns, 10), [csv((1, "a"), (2, "b")), csv((4, "c")), csv((6, "d"), (5, "time,x"), (7, "e")), csv((8, "f")), csv((9, "g"), (10, "time,y"), (11, "h")), csv((12, "i"))])
    assert [[(r["value"], r["header"]) for r in part] for part in got] == [
        [], [], [("a", "time,x"), ("b", "time,x"), ("c", "time,x"), ("d", "time,x"), ("e", "time,x")], [("f", "time,x")], [("g", "time,x"), ("h", "time,y")], [("i", "time,y")],
    ]


def test_too_many_waiting_lines_go_on_without_a_header():
    columns = ["source_file", "line_ord", "value"]
    got = fed(HeaderInForce("value", columns, 3), [csv((1, "a"), (2, "b")), csv((3, "c"), (4, "d")), csv((5, "e")), csv((6, "time,x"), (7, "f"))])
    rows = [(r["value"], r["header"]) for part in got for r in part]
    assert rows == [("a", None), ("b", None), ("c", None), ("d", None), ("e", "time,x"), ("f", "time,x")]


ROLES = {"# XMLCON_START": "xmlcon_start", "# XMLCON_END": "xmlcon_end", "*END*": "header_end"}


def scan_line(i, v):
    role = ROLES.get(v) or {"*": "header", "#": "comment", "A": "scan"}.get(v[0], "ignore")
    return {"source_file": "k", "line_ord": i, "value": v, "state_order": i, "state_mark": role}


def test_scans_name_the_preamble_before_them():
    pieces = [
        ["A1", "noise"], ["* head", "# note", "# XMLCON_START", "# <a>"], ["#<b>", "# XMLCON_END", "*END*", "A2", "* after the end", "A3"],
        ["A4"], ["# XMLCON_START", "* <c>", "# XMLCON_END", "A5"], ["# XMLCON_START", "# XMLCON_END", "A6"],
    ]
    n, batches = 0, []
    for lines in pieces:
        batches.append([scan_line(n + i, v) for i, v in enumerate(lines)])
        n += len(lines)
    rows = [r for part in fed(Preamble("value", ["source_file", "line_ord", "value"]), batches) for r in part]
    assert [(r["value"], r["scan"], r["version"]) for r in rows if r["role"] == "scan"] == [("A1", 1, 0), ("A2", 2, 1), ("A3", 3, 1), ("A4", 4, 1), ("A5", 5, 2), ("A6", 6, 2)]
    documents = {r["version"]: (r["header"], r["xmlcon"]) for r in rows if r["role"] == "preamble"}
    assert documents == {1: ("* head\n# note\n", "<a>\n<b>\n"), 2: ("* head\n# note\n", " <c>\n")}
    assert [r["value"] for r in rows if r["role"] == "ignore"] == ["noise"]


def greedy(times, span, most, mark):
    """Batches one record at a time, those that have closed when the watermark is ``mark``."""
    batches = []
    for t in sorted(times):
        if not batches or len(batches[-1]) == most or t >= batches[-1][0] + span:
            batches.append([])
        batches[-1].append(t)
    return [b for b in batches if (len(b) == most and b[-1] < mark) or b[0] + span <= mark]


@pytest.mark.parametrize("seed", range(20))
def test_batches_close_by_count_or_time(seed):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(0, 400_000_000, 1000), 150))
    span, most, delay = rng.choice([10_000_000, 40_000_000]), rng.choice([3, 7]), 30_000_000
    # Arrival is late by less than the delay of the watermark.
    arrival = sorted(times, key=lambda t: t + rng.randrange(delay))
    processor, store = CountOrTime(["t"], span, most), Store()
    processor.init(store)
    mark, out = 0, []
    for i in range(0, len(arrival), 11):
        piece = [t for t in arrival[i : i + 11]]
        assert all(t > mark for t in piece)
        frame = pd.DataFrame({"t": piece, "state_time_us": piece, "state_order": piece})
        assert list(processor.handleInputRows(("k",), iter([frame]), Mark(mark // 1000))) == []
        mark = max(mark, max(piece) - delay)
        mark -= mark % 1000
        due = {ms for ms in store.timers if ms * 1000 <= mark}
        store.timers -= due
        for _ in sorted(due):
            out += [r for part in processor.handleExpiredTimer(("k",), Mark(mark // 1000), None) for r in part.to_dict("records")]
    expected = greedy(times, span, most, mark)
    assert [r["t"] for r in out] == [t for b in expected for t in b]
    assert [r["batch_no"] for r in out] == [n for n, b in enumerate(expected, 1) for _ in b]
    assert [r["closed_by"] for r in out] == ["count" if len(b) == most else "time" for b in expected for _ in b]
    assert [r["batch_start_us"] for r in out] == [b[0] for b in expected for _ in b]


def test_chunks_keep_nulls_and_types():
    rows = pd.DataFrame({"a": [1, 2], "b": [None, "x"], "c": pd.to_datetime(["2024-01-01", None])})
    again = unpacked([packed(rows), packed(rows.iloc[:1])])
    assert again["a"].tolist() == [1, 2, 1] and again["b"].tolist()[1] == "x" and again["c"].isna().tolist() == [False, True, False]


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/a/one.json"
    assert not path_exists(spark, path) and names_below(spark, f"{tmp_path}/a") == []
    assert write_new(spark, path, "é1") and not write_new(spark, path, "other")
    assert read_small(spark, path) == "é1" and names_below(spark, f"{tmp_path}/a") == ["one.json"]


GGA = "2024-02-17T00:00:{:02d}Z $GPGGA,000000.00,3242.3916,N,11714.1640,W,1,10,0.8,10.2,M,-34.3,M,,*66"


def sentences(spark, rows):
    df = spark.createDataFrame(rows, "source_file string, line_ord bigint, value string")
    return df.withColumn("ingest_ts", F.lit("2024-02-17 01:00:00").cast("timestamp"))


def test_a_micro_batch_is_published_whole_and_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    options = JobOptions(campaign_id="c", platform_id="p", provider_rules=(ProviderRule("buoys", "buoy"),))
    write = sentence_batches(out, options)
    first = sentences(spark, [("buoy", 2, GGA.format(1)), ("buoy", 1, GGA.format(1)), ("ship", 3, GGA.format(1)), ("ship", 4, "noise"), ("ship", 5, "")])

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(Commits, "publish", broken)
        with pytest.raises(OSError):
            write(first, 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        published_table(spark, out, "data")
    write(first, 0)
    write(first, 0)
    write(sentences(spark, []), 1)
    write(sentences(spark, [("buoy", 6, GGA.format(1))]), 2)
    rows = published_table(spark, out, "data").orderBy("batch_id", "source_file").collect()
    assert [(r["batch_id"], r["source_file"], r["line_ord"], r["provider"], r["campaign"]) for r in rows] == [
        (0, "buoy", 1, "buoys", "c00"), (0, "ship", 3, None, "c00"), (2, "buoy", 6, "buoys", "c00")
    ]
    rejects = published_table(spark, out, "rejects").orderBy("line_ord").collect()
    assert [(r["line_ord"], r["reject_reason"]) for r in rejects] == [(4, "not_a_sentence"), (5, "blank")]
    results = published_table(spark, out, "results", "stream").orderBy("batch_id").collect()
    assert [(r["status"], r["reason"], r["record_count"], r["reject_count"]) for r in results] == [("ok", None, 2, 2), ("skipped", "empty batch", 0, 0), ("ok", None, 1, 0)]
    said = published_table(spark, out, "telemetry").where("batch_id = 0").first()["value"]
    assert '"source":"stream"' in said and '"platform_id":"p"' in said and "provider" not in said
    assert published_table(spark, out, "data", "another").count() == 0


def test_windows_once_and_late_records_listed(spark, tmp_path):
    out = str(tmp_path)
    write = window_batches(out, ["k"], seconds=10, delay_seconds=5)

    def batch(*seconds):
        rows = [("a", i, s) for i, s in enumerate(seconds)]
        df = spark.createDataFrame(rows, "k string, n int, s int")
        return df.select("k", "n", F.timestamp_seconds("s").alias("time"), F.col("s").cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))

    for i, rows in enumerate([(1, 9, 12), (3, 8, 24, None), (20, 18, 11), (None,), (31, 19)]):
        write(batch(*rows), i)
        write(batch(*rows), i)
    windows = published_table(spark, out, "windows").orderBy("window_start").collect()
    # Marks: 7, 19, 19, 19, 26; 3 s is behind 7 s, 18 s and 11 s behind 19 s, and 19 s is not.
    assert [(r["batch_id"], r["record_count"], r["lat_min"], r["lat_max"]) for r in windows] == [(1, 3, 1, 9), (4, 2, 12, 19)]
    rejects = published_table(spark, out, "rejects").collect()
    assert sorted((r["reject_reason"], r["latitude"] or 0) for r in rejects) == [("bad_time", 0), ("bad_time", 0), ("late", 3), ("late", 11), ("late", 18)]
