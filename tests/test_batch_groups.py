"""Count-or-time batches keep their state by group of keys."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marinelake.streaming.sequences import CountOrTime, stream_batches
from tests.test_live import Mark, Store, greedy


@pytest.mark.parametrize("seed", range(5))
def test_keys_of_a_group(seed):
    rng = random.Random(seed)
    span, most, delay = 40_000_000, rng.choice([1, 3, 7]), 30_000_000
    records = [(k, t) for k in ("a", "b", "c", "d") for t in rng.choices(range(0, 200_000_000, 1000), k=rng.randrange(1, 80))]
    arrival = sorted(records, key=lambda r: r[1] + rng.randrange(delay))
    processor, store = CountOrTime(["k", "t"], span, most, "state_key"), Store()
    processor.init(store)
    mark, out = 0, []
    for i in range(0, len(arrival), 13):
        piece = [r for r in arrival[i : i + 13] if r[1] > mark]
        assert len(piece) == len(arrival[i : i + 13])
        frame = pd.DataFrame({"k": [k for k, _ in piece], "t": [t for _, t in piece]})
        assert list(processor.handleInputRows((1,), iter([frame.assign(state_key=frame.k, state_time_us=frame.t, state_order=frame.t)]), None)) == []
        mark = max(mark, max(frame.t) - delay)
        mark -= mark % 1000
        due = {ms for ms in store.timers if ms * 1000 <= mark}
        store.timers -= due
        for _ in due:
            out += [r for part in processor.handleExpiredTimer((1,), Mark(mark // 1000), None) for r in part.to_dict("records")]
    for key in ("a", "b", "c", "d"):
        expected = greedy([t for k, t in records if k == key], span, most, mark)
        got = [(r["t"], r["batch_no"], r["batch_start_us"], r["closed_by"]) for r in out if r["k"] == key]
        assert got == [(t, n, b[0], "count" if len(b) == most else "time") for n, b in enumerate(expected, 1) for t in b]


def test_nulls_and_large_numbers(spark, tmp_path):
    """2000 keys in 4 groups, one of them null; numbers beyond 2^53 beside nulls of their group."""
    big = 2**60 + 1
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2000 > 0, F.col("id") % 2000 + big).alias("k"), F.timestamp_seconds(1000 + F.floor(F.col("id") / 2000)).alias("time"),
        F.col("id").alias("line_ord"), F.when(F.col("id") % 3 > 0, F.col("id") + big).alias("n"),
    )
    last = spark.sql(f"SELECT {big}L AS k, timestamp_seconds(10000) AS time, 9000L AS line_ord, 0L AS n")
    rows.unionByName(last).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    batches = stream_batches(stream, ["k"], seconds=60, max_records=2, groups=4)
    assert batches.columns == [*rows.columns, "batch_no", "closed_by", "batch_start"]
    batches.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(
        availableNow=True
    ).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select("k", "time", "line_ord", "n", "batch_no", "closed_by", F.col("batch_start").cast("bigint"))
    second = F.floor(F.col("line_ord") / 2000)
    expected = rows.select(
        "*", F.when(second < 2, 1).otherwise(2).cast("bigint"), F.when(second < 2, "count").otherwise("time"), F.when(second < 2, 1000).otherwise(1002).cast("bigint")
    )
    assert got.count() == 6000 and got.exceptAll(expected).count() == 0


def test_calls_to_the_state_do_not_grow_with_the_keys():
    class Counted(Store):
        calls = 0

        def registerTimer(self, ms):
            Counted.calls += 1
            super().registerTimer(ms)

    processor = CountOrTime(["t"], 10, 2, "state_key")
    processor.init(Counted())
    keys = [f"k{i}" for i in range(1000)]
    frame = pd.DataFrame({"t": 5, "state_key": keys, "state_time_us": 5, "state_order": range(1000)})
    list(processor.handleInputRows((1,), iter([frame]), None))
    (rows,) = processor.handleExpiredTimer((1,), Mark(1), None)
    assert len(rows) == 1000 and set(rows.batch_no) == {1} and Counted.calls == 1
