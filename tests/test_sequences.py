"""Sequence operators against brute force, with small blocks and hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from marinelake.operators import sequence
from marinelake.operators.quality import dedupe_first, dedupe_records, valid_positions
from marinelake.operators.throttle import downsample_min_gap, kept_records, throttle_stats


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(sequence, "BLOCK_BITS", 3)


def _records(seed, n=1500):
    """A hot key, ties in time, gaps in the order and null keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice([None, "hot", "hot", "hot", "b", "c"])
        us = rng.choice([rng.randint(0, 2000), rng.randint(0, 20) * 100]) * 500_000
        rows.append((key, us, i * 3 + rng.randint(0, 2), rng.random() < 0.02))
    return rows


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "k STRING, us BIGINT, id BIGINT, forced BOOLEAN")
    return df.withColumn("time", F.timestamp_micros("us")).repartition(5)


def _greedy(rows, gap_us):
    kept, last = [], {}
    for key, us, number, forced in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if forced or key not in last or us - last[key] >= gap_us:
            kept.append(number)
            last[key] = us
    return sorted(kept)


@pytest.mark.parametrize("gap", [1, 30])
@pytest.mark.parametrize("chunk", [1, 3, 1024])
@pytest.mark.parametrize("force", [None, "forced"])
def test_min_gap(spark, gap, chunk, force):
    rows = _records(gap)
    df = _frame(spark, rows)
    expected = _greedy([(k, u, i, f and force is not None) for k, u, i, f in rows], gap * 1_000_000)
    got = downsample_min_gap(df, ["k"], "time", "id", gap, force, chunk)
    assert sorted(r.id for r in got.select("id").collect()) == expected
    assert got.columns == df.columns


def test_min_gap_regular_clock_never_merges(spark):
    """A strictly regular clock keeps every step of the summaries apart."""
    df = spark.range(5000).selectExpr("'a' AS k", "timestamp_micros(id * 250000) AS time", "id")
    got = sorted(r.id for r in kept_records(df, ["k"], "time", "id", 3, chunk_gaps=4).collect())
    assert got == list(range(0, 5000, 12))


def test_min_gap_is_at_least_one_second(spark):
    df = spark.range(10).selectExpr("1 AS k", "timestamp_micros(id * 500000) AS time", "id")
    assert kept_records(df, ["k"], "time", "id", 0).count() == 5


def test_min_gap_survives_small_arrow_batches(spark):
    rows = _records(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = kept_records(_frame(spark, rows), ["k"], "time", "id", 5, chunk_gaps=8)
        expected = _greedy([(k, u, i, False) for k, u, i, _ in rows], 5_000_000)
        assert sorted(r.id for r in got.select("id").collect()) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_throttle_stats(spark):
    df = _frame(spark, _records(4)).where("k = 'b'")
    sent = kept_records(df, ["k"], "time", "id", 10)
    row = throttle_stats(df, sent, ["k"]).first()
    assert row.records_sent == sent.count()
    assert row.records_sent + row.records_suppressed == df.count()


def test_positions_across_blocks(spark, small_blocks):
    df = _frame(spark, _records(1)).where("k IS NOT NULL")
    numbered = sequence.with_position(df, ["k"], "id").collect()
    for key in ("hot", "b", "c"):
        ids = sorted((r.id, r.position) for r in numbered if r.k == key)
        assert [p for _, p in ids] == list(range(1, len(ids) + 1))


def test_changed_across_blocks(spark, small_blocks):
    df = _frame(spark, _records(2)).where("k IS NOT NULL").withColumn(
        "time", F.date_trunc("minute", "time")
    )
    rows = sorted((r.k, r.id, r.time) for r in df.collect())
    expected = [
        r[1] for i, r in enumerate(rows) if i == 0 or rows[i - 1][0] != r[0] or rows[i - 1][2] != r[2]
    ]
    got = sequence.changed_readings(df, ["k"], "id").collect()
    assert sorted(r.id for r in got) == sorted(expected)


def test_batches_close_on_count_and_time(spark, small_blocks):
    df = spark.range(10).selectExpr(
        "'s' AS k", "id AS line_ord", "timestamp_seconds(CASE WHEN id < 7 THEN 10 ELSE 70 END) AS time"
    )
    rows = sequence.assign_batches(df, ["k"], max_records=3).orderBy("line_ord").collect()
    assert [r.batch_part for r in rows] == [0, 0, 0, 1, 1, 1, 2, 0, 0, 0]


def test_dedupe_parity_loses_and_merge_keeps(spark):
    rows = [("f", 1, 10, 5.0, None), ("f", 2, 10, None, 7.0), ("f", 3, 11, 6.0, None)]
    df = spark.createDataFrame(
        rows, "source_file STRING, line_ord BIGINT, time INT, latitude DOUBLE, speed DOUBLE"
    )
    keys = ["source_file", "time"]
    first = dedupe_first(df, keys).orderBy("time").collect()
    assert [(r.latitude, r.speed) for r in first] == [(5.0, None), (6.0, None)]
    merged = dedupe_first(df, keys, merge=True).orderBy("time").collect()
    assert [(r.line_ord, r.latitude, r.speed) for r in merged] == [(1, 5.0, 7.0), (3, 6.0, None)]


def test_grids_are_not_deduplicated(spark):
    rows = [("a.raw", "adcp", 1, 1), ("a.raw", "adcp", 1, 2), ("b.csv", "csv", 1, 1), ("b.csv", "csv", 1, 2)]
    df = spark.createDataFrame(rows, "source_file STRING, file_type STRING, time INT, line_ord BIGINT")
    assert sorted(r.source_file for r in dedupe_records(df).collect()) == ["a.raw", "a.raw", "b.csv"]


def test_valid_positions(spark):
    rows = [("a", 1.0, 2.0), ("a", None, 2.0), ("b", None, 1.0), ("b", 3.0, None)]
    df = spark.createDataFrame(rows, "source_file STRING, latitude DOUBLE, longitude DOUBLE")
    kept = sorted((r.source_file, r.latitude or 0) for r in valid_positions(df).collect())
    assert kept == [("a", 1.0), ("b", 0), ("b", 3.0)]
