"""The ingest job by lists of files: names, missing and vanishing files, companions, runs."""

import glob
import json
import os
import struct

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import marinelake.plans.ingest as ingest
from marinelake.options import JobOptions
from marinelake.plans.event_ingest import event_batches
from marinelake.plans.ingest import ingest_directory, ingest_files
from marinelake.sinks.tables import compact, current_table, expire_runs
from marinelake.streaming.commits import published_table

CSV = "time,latitude,longitude,TEMP\n2024-01-01T00:00:{:02d}Z,41.2,1.8,{}\n"
SCAN = "11F0B8" * 5 + "000" * 8 + "16E3607A8C2040" + "912293" + "60AAAB62"


def save(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def statuses(results):
    return {r["source_file"].rsplit("/", 1)[-1]: (r["status"], r["record_count"]) for r in results.collect()}


def test_lists_of_files_with_any_name(spark, tmp_path):
    names = ["a[1].csv", "b{x,y}.csv", "c*.csv", "d e.csv", "é.csv", "f?.csv"]
    paths = [save(f"{tmp_path}/in/{n}", CSV.format(i, i)) for i, n in enumerate(names)]
    save(f"{tmp_path}/in/a1.csv", CSV.format(9, 9))
    hex_ = save(f"{tmp_path}/casts/One.hex", f"* head\n*END*\n{SCAN}\n{SCAN}\n")
    save(f"{tmp_path}/casts/one.HDR", "** Station: S1\n* NMEA Latitude = 30 00.00 N\n")
    missing = f"{tmp_path}/in/none.csv"
    out = f"{tmp_path}/out"
    got = statuses(ingest_files(spark, [*paths, paths[0], hex_, missing], out, JobOptions()))
    assert got == {**{n: ("ok", 1) for n in names}, "One.hex": ("ok", 2), "none.csv": ("error", 0)}
    cast = current_table(spark, out, "data").where(F.col("source_file").endswith(".hex")).collect()
    assert [(r["station"], r["latitude"]) for r in cast] == [("S1", 30.0)] * 2
    again = ingest_files(spark, [missing], out, JobOptions()).collect()
    assert [(r["status"], r["error"]) for r in again] == [("error", f"file not found: {missing}")]
    assert current_table(spark, out, "data").count() == len(names) + 2


def test_a_file_that_vanishes_is_an_error(spark, tmp_path, monkeypatch):
    keep, lose = (save(f"{tmp_path}/in/{n}.csv", CSV.format(1, 1)) for n in ("keep", "lose"))
    dedupe = ingest.dedupe_records

    def meanwhile(*args, **more):
        if os.path.exists(lose):
            os.remove(lose)
        return dedupe(*args, **more)

    monkeypatch.setattr(ingest, "dedupe_records", meanwhile)
    got = statuses(ingest_directory(spark, f"{tmp_path}/in", f"{tmp_path}/out", JobOptions()))
    assert got == {"keep.csv": ("ok", 1), "lose.csv": ("error", 0)} and os.path.exists(keep)


def test_later_failures_leave_earlier_rows(spark, tmp_path):
    out, options = f"{tmp_path}/out", JobOptions()
    path = save(f"{tmp_path}/in/a.csv", CSV.format(1, 5))
    other = save(f"{tmp_path}/in/b.csv", "time,TEMP\nnever,1\n")
    ingest_files(spark, [path, other], out, options)
    save(path, "time,latitude,longitude,TEMP\n")  # now without rows
    ingest_files(spark, [path], out, options)

    def now():
        rows = current_table(spark, out, "data").collect()
        rejects = current_table(spark, out, "rejects").collect()
        return [(r["source_file"].rsplit("/", 1)[-1], r["TEMP"]) for r in rows], [r["reject_reason"] for r in rejects]

    assert now() == ([("a.csv", 5.0)], ["bad_time"])
    last = compact(spark, out)
    assert now() == ([("a.csv", 5.0)], ["bad_time"])
    expire_runs(spark, out, last)
    assert now() == ([("a.csv", 5.0)], ["bad_time"]) and statuses(current_table(spark, out, "results")) == {"a.csv": ("ok", 1), "b.csv": ("skipped", 0)}
    save(path, CSV.format(1, 7))
    ingest_files(spark, [path], out, options)
    assert now() == ([("a.csv", 7.0)], ["bad_time"])


def test_events_of_one_path_are_taken_in_once(spark, tmp_path):
    out = f"{tmp_path}/out"
    path = save(f"{tmp_path}/in/a.csv", CSV.format(1, 5))
    write = event_batches(out, JobOptions())

    def batch(*values):
        return spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "source_file string, line_ord bigint, value string")

    event = f'{{"event": "fileadd", "file_added_path": "{path}"}}'
    same = f'{{"event": "fileadd", "path": "file:{path}"}}'
    for i, rows in enumerate([batch(event, same, "no json", '{"event": "x"}'), batch(same, event), batch()]):
        write(rows, i)
        write(rows, i)
    events = published_table(spark, f"{out}/control", "events").orderBy("batch_id", "line_ord").collect()
    assert [(r["batch_id"], r["status"]) for r in events] == [(0, "queued"), (0, "duplicate"), (0, "skipped"), (0, "skipped"), (1, "duplicate"), (1, "duplicate")]
    results = spark.read.parquet(f"{out}/results").collect()
    assert [(r["status"], r["record_count"]) for r in results] == [("ok", 1)]


def test_geoparquet_runs(spark, tmp_path):
    out, options = f"{tmp_path}/out", JobOptions(geoparquet=True, dataset="a b/c")
    paths = [save(f"{tmp_path}/in/{n}.csv", CSV.format(1, i)) for i, n in enumerate("ab")]
    nowhere = save(f"{tmp_path}/in/n.csv", "time,TEMP\n2024-01-01T00:00:01Z,9\n")
    ingest_files(spark, [*paths, nowhere], out, options)
    assert not os.path.exists(f"{out}/data")

    def now():
        rows = current_table(spark, out, "geo").select("source_file", "TEMP", "geometry", "dataset").collect()
        assert {r["dataset"] for r in rows} == {"a b/c"}
        return sorted((r["source_file"].rsplit("/", 1)[-1], r["TEMP"], r["geometry"] and struct.unpack("<BIdd", r["geometry"])) for r in rows)

    point = (1, 1, 1.8, 41.2)
    assert now() == [("a.csv", 0.0, point), ("b.csv", 1.0, point), ("n.csv", 9.0, None)]
    written = glob.glob(f"{out}/geo/**/*.parquet", recursive=True)
    for path in written:
        geo = json.loads(pq.read_metadata(path).metadata[b"geo"])
        assert geo["columns"]["geometry"].get("bbox") in ([1.8, 41.2, 1.8, 41.2], None)
    # A file of an attempt that no run names is not read.
    stray = pq.read_table(written[0])
    pq.write_table(stray, f"{os.path.dirname(written[0])}/part-stray.parquet")
    save(paths[0], CSV.format(1, 7))
    ingest_files(spark, [paths[0]], out, options)
    expected = [("a.csv", 7.0, point), ("b.csv", 1.0, point), ("n.csv", 9.0, None)]
    assert now() == expected
    last = compact(spark, out)
    assert now() == expected
    expire_runs(spark, out, last)
    assert now() == expected and len(os.listdir(f"{out}/commits/geo")) <= 2  # and its checksum


def test_an_aborted_geoparquet_write_leaves_nothing(spark, tmp_path):
    from marinelake.sinks.geoparquet import write_committed

    rows = spark.range(20).selectExpr("id", "1.0D + id AS latitude", "IF(id = 19, raise_error('x'), 2.0D) AS longitude", "'r' AS run")
    try:
        write_committed(rows.repartition(2), f"{tmp_path}/geo", f"{tmp_path}/commits", "r", ["run"])
        raise AssertionError("written")
    except Exception as error:
        assert "x" in str(error) and not isinstance(error, AssertionError)
    assert not os.path.exists(f"{tmp_path}/commits")
