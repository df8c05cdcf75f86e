"""Real files: scans, casts, archives, the ingest job, GeoParquet and the streams."""

import io
import json
import struct
import tarfile
from datetime import datetime
from functools import reduce
from operator import xor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marinelake import JobOptions, ProviderRule
from marinelake.operators.sequence import with_position, with_previous
from marinelake.plans.ingest import ingest_directory, run_summary
from marinelake.sinks.geoparquet import write_geoparquet
from marinelake.sinks.tables import current_table, write_table
from marinelake.sources.archives import read_archives
from marinelake.sources.lines import first_files, glob_of, list_files, manifest, read_lines
from marinelake.streaming.lines import micro_batch_writer, stream_lines, stream_sentences
from marinelake.streaming.state import stream_changed, stream_min_gap
from tests.test_lines import SCAN

CSV = (
    "time,latitude,longitude,depth,TEMP,PSAL,CNDC\n"
    "2021-09-12T04:00:00Z,-8.25,-34.5,55.0,26.5,36.1,5.6\n"
    "2021-09-12T04:20:00Z,-8.25,-34.5,55.0,26.4,36.1,5.6\n"
    "2021-09-12T04:20:00Z,-8.25,-34.5,55.0,99.0,36.1,5.6\n"
    "2021-09-12T04:40:00Z,-8.25,-34.5,55.0,26.3,36.1,5.6\n"
)


def _sentence(body):
    return f"${body}*{reduce(xor, body.encode()):02X}"


NMEA = "".join(
    f"2021-09-12T05:00:0{i}.250Z "
    + _sentence(f"GPGGA,05000{i}.00,0815.25{i}0,S,03430.1000,W,1,9,0.9,{5 + i}.1,M,-7.0,M,,")
    + "\n"
    for i in range(3)
) + "not a sentence\n"
CNV = "# name 0 = latitude: Lat\n# name 1 = longitude: Lon\n# name 2 = depSM: Depth\n*END*\n 30 -160 1.0\n 30 -160 3.0\n"
HDR = "* NMEA Latitude = 30 00.00 N\n* NMEA UTC (Time) = Jun 16 2022  18:16:30\n** Station: 11901\n"
XMLCON = (
    "<SBE_InstrumentConfiguration><Instrument><FrequencyChannelsSuppressed>0"
    "</FrequencyChannelsSuppressed><NmeaPositionDataAdded>1</NmeaPositionDataAdded>"
    "<ScanTimeAdded>1</ScanTimeAdded><SensorArray><Sensor index='0'><TemperatureSensor>"
    "<G>4.34e-3</G><H>6.4e-4</H><I>2.3e-5</I><J>2.0e-6</J><F0>1000</F0>"
    "</TemperatureSensor></Sensor></SensorArray></Instrument></SBE_InstrumentConfiguration>"
)


def _tar(path, members):
    with tarfile.open(path, "w:gz") as tar:
        for name, text in members:
            info = tarfile.TarInfo(name)
            if text is None:
                info.type, info.linkname = tarfile.SYMTYPE, "/etc/passwd"
                tar.addfile(info)
            else:
                info.size = len(text)
                tar.addfile(info, io.BytesIO(text.encode()))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    base = tmp_path / "in"
    (base / "moor.CSV").write_text(CSV)
    (base / "empty.csv").write_text("time,latitude,longitude\n")
    (base / "sub" / "track.txt").write_text(NMEA)
    (base / "p.cnv").write_text(CNV)
    (base / "Cast1.hex").write_text("* head\n*END*\n" + f"{SCAN}\n" * 3)
    (base / "CAST1.hdr").write_text(HDR)
    (base / "cast1.XMLCON").write_text(XMLCON)
    (base / "current.raw").write_bytes(b"\x7f\x7f")
    _tar(base / "more.tar.gz", [("a/moor.csv", CSV), ("a/track.txt", NMEA), ("../evil.csv", CSV),
                                ("/abs.csv", CSV), ("link.csv", None), ("notes.md", "x")])
    return base


def test_null_keys_and_orders_stay(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 1 << 40)], "k STRING, o BIGINT")
    got = with_position(df, ["k"], "o").collect()
    assert sorted((str(r.k), r.position) for r in got) == [("None", 1), ("None", 2), ("a", 1), ("a", 2)]
    last = with_previous(df, ["k"], "o", "o", "before").collect()
    assert len(last) == 4 and {r.before for r in last if r.o == 1 << 40} == {2}


PATTERNS = "*.csv,*.CSV,*.txt,*.hex,*.cnv,*.raw,*.tar.gz"


def test_manifest_and_first_files(spark, folder):
    files = manifest(spark, str(folder), PATTERNS)
    got = {r.source_file: r.file_type for r in files.collect()}
    assert got == {"moor.CSV": "csv", "empty.csv": "csv", "track.txt": "nmea", "p.cnv": "cnv",
                   "Cast1.hex": "hex", "current.raw": "adcp", "more.tar.gz": "archive"}
    assert [r.source_file for r in first_files(files, 2).collect()] == ["Cast1.hex", "current.raw"]


def test_line_order_across_splits(spark, tmp_path):
    """One file in many splits keeps its order."""
    path = tmp_path / "long.txt"
    path.write_text("\n".join(f"{i:09d}" for i in range(60000)))
    settings = {"spark.sql.files.maxPartitionBytes": "16384", "spark.sql.files.openCostInBytes": "16384"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = read_lines(spark, str(tmp_path), glob_of([".txt"]))
        assert lines.rdd.getNumPartitions() > 4
        placed = with_position(lines, ["source_file"], "line_ord").select("position", "value")
        assert placed.where(F.col("position") != F.col("value").cast("int") + 1).count() == 0
        assert placed.count() == 60000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_archive_scan(spark, folder):
    members = read_archives(spark, str(folder)).groupBy("member").count().collect()
    assert {r.member: r["count"] for r in members} == {"a/moor.csv": 5, "a/track.txt": 4}


def test_ingest_directory(spark, folder, tmp_path):
    options = JobOptions(
        campaign_id="RR 2205", watch_patterns=PATTERNS,
        provider_rules=(ProviderRule("emso", "moor", attributes={"net": "emso"}),),
    )
    out = str(tmp_path / "out")
    results = ingest_directory(spark, str(folder), out, options, day=F.lit("2024-03-01"))
    by_name = {r.source_file.rsplit("/", 1)[1]: r for r in results.collect()}
    counts = {n: (r.status, r.record_count) for n, r in by_name.items()}
    assert counts == {
        "moor.CSV": ("ok", 3), "empty.csv": ("skipped", 0), "track.txt": ("ok", 3),
        "p.cnv": ("ok", 2), "Cast1.hex": ("ok", 3), "current.raw": ("skipped", 0),
        "more.tar.gz": ("ok", 6),
    }
    assert by_name["empty.csv"].reason == "no records parsed"
    assert by_name["track.txt"].lat_max == pytest.approx(-(8 + 15.25 / 60), abs=1e-6)
    summary = run_summary(results).first()
    assert (summary.files, summary.ok, summary.skipped, summary.total_records) == (7, 5, 2, 17)

    data = spark.read.parquet(f"{out}/data")
    assert data.select("campaign", "dataset").distinct().collect() == [("rr-2205", "sensordata")]
    moor = data.where("source_file LIKE '%moor.CSV'").orderBy("time").collect()
    assert [r.TEMP for r in moor] == [26.5, 26.4, 26.3]
    assert (moor[0].provider, moor[0].attributes) == ("emso", {"net": "emso"})
    cast = data.where("source_file LIKE '%Cast1.hex'").orderBy("scan").collect()
    assert [r.scan for r in cast] == [1, 2, 3]
    assert (cast[0].station, cast[0].latitude, cast[0].longitude) == ("11901", 30.0, -160.636)
    assert cast[0].time == datetime(2022, 6, 16, 18, 16, 32)
    assert cast[0].temperature is not None and cast[0].pressure is None
    assert cast[0].hex_scan == SCAN

    meta = spark.read.parquet(f"{out}/metadata").where("source_file LIKE '%moor.CSV'").first()
    assert meta.record_count == 3 and meta.sensor_stats["TEMP"]["max"] == 26.5
    rejects = spark.read.parquet(f"{out}/rejects").groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rejects} == {"not_a_sentence": 2}

    again = ingest_directory(spark, str(folder), out, options, day=F.lit("2024-03-01"))
    assert again.count() == 7
    assert current_table(spark, out, "data").count() == 17


def test_a_second_folder_adds_and_a_rerun_replaces(spark, tmp_path):
    out, options = str(tmp_path / "out"), JobOptions(provider="r2r")
    header = "time,latitude,longitude,TEMP\n"
    for name, text in {
        "a/my file+%41.csv": "2023-06-01T00:00:00Z,1,2,3\n06/02/2023 01:00:00,1,2,4\n1 Jun 2023 00:30,1,2,5\nno time,1,2,6\n",
        "b/x.csv": "20230601T000000Z,1,2,7\n",
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(header + text)
    (tmp_path / "b" / "broken.tar.gz").write_bytes(b"\x1f\x8b not an archive")
    _tar(tmp_path / "b" / "y.tgz", [("z.csv", header + "2023-06-01T00:00:00Z,1,2,8\n")])
    first = ingest_directory(spark, str(tmp_path / "a"), out, options).collect()
    assert [(r.source_file.rsplit("/", 1)[1], r.status, r.record_count) for r in first] == [("my file+%41.csv", "ok", 3)]
    second = ingest_directory(spark, str(tmp_path / "b"), out, options).collect()
    assert {r.source_file.rsplit("/", 1)[1]: r.status for r in second} == {"x.csv": "ok", "broken.tar.gz": "error", "y.tgz": "ok"}
    for _ in range(2):
        rows = current_table(spark, out, "data").collect()
        assert sorted(r.TEMP for r in rows) == [3.0, 4.0, 5.0, 7.0, 8.0]
        assert {r.provider for r in rows} == {"r2r"}
        assert [r.reject_reason for r in current_table(spark, out, "rejects").collect()] == ["bad_time"]
        listed = {c for r in current_table(spark, out, "metadata").collect() for c in r["columns"]}
        assert "TEMP" in listed and not listed & {"extra", "file_type", "attributes"}
        (tmp_path / "a" / "my file+%41.csv").write_text(header + "2023-06-01T00:00:00Z,1,2,3\n2023-06-01T01:00:00Z,1,2,4\n2023-06-01T02:00:00Z,1,2,5\nx,1,2,3\n")
        ingest_directory(spark, str(tmp_path / "a"), out, options)


def test_rerun_replaces_only_its_days(spark, tmp_path):
    out, options = str(tmp_path / "t"), JobOptions()
    rows = spark.createDataFrame(
        [("a", datetime(2024, 1, d), 1.0, 1.0) for d in (1, 2)],
        "source_file STRING, time TIMESTAMP, latitude DOUBLE, longitude DOUBLE",
    )
    write_table(rows, out, options, day=F.col("time"))
    write_table(rows.where("day(time) = 2"), out, options, day=F.col("time"))
    assert spark.read.parquet(out).count() == 2


def test_geoparquet(spark, tmp_path):
    out = str(tmp_path / "geo")
    df = spark.createDataFrame(
        [("a", 1.5, 2.5), ("a", None, 2.0), ("a", -3.0, 4.0)],
        "source_file STRING, latitude DOUBLE, longitude DOUBLE",
    ).coalesce(1)
    for _ in range(2):
        write_geoparquet(df, out)
    rows = spark.read.parquet(out).orderBy("latitude").collect()
    assert [bytes(r.geometry) for r in rows] == [
        struct.pack("<BIdd", 1, 1, lon, lat) for lon, lat in ((4.0, -3.0), (2.5, 1.5))
    ]
    (file,) = list((tmp_path / "geo").glob("*"))
    geo = json.loads(pq.read_metadata(file).metadata[b"geo"])
    assert geo["primary_column"] == "geometry"
    assert geo["columns"]["geometry"]["crs"]["id"] == {"authority": "EPSG", "code": 4326}
    assert geo["columns"]["geometry"]["bbox"] == [2.5, -3.0, 4.0, 1.5]


def test_list_outputs_reads_no_content(spark, folder):
    assert list_files(spark, str(folder)).columns == ["path", "length", "modificationTime"]


def _drain(stream, tmp_path, name):
    out = str(tmp_path / name)
    (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", f"{out}-state").trigger(availableNow=True)
        .start().awaitTermination()
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_stream_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    (source / "a.txt").write_text(NMEA)
    out, state = str(tmp_path / "o"), str(tmp_path / "s")

    def run():
        records = stream_sentences(stream_lines(spark, str(source), "*.txt"))
        (
            records.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", state).trigger(availableNow=True)
            .start().awaitTermination()
        )
        return spark.read.parquet(out).count()

    assert run() == 3
    assert run() == 3
    (source / "b.txt").write_text(NMEA)
    assert run() == 6


def test_micro_batches_keep_first(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    (source / "a.txt").write_text(NMEA + NMEA)
    out = str(tmp_path / "o")
    records = stream_sentences(stream_lines(spark, str(source), "*.txt"))
    (
        records.writeStream.foreachBatch(micro_batch_writer(out, JobOptions()))
        .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True)
        .start().awaitTermination()
    )
    assert spark.read.parquet(out).count() == 3


def test_state_carries_over_micro_batches(spark, tmp_path):
    """Each file is one micro-batch; the result equals that of one pass."""
    source = tmp_path / "src"
    schema = "k STRING, time TIMESTAMP, id BIGINT"
    for part in range(3):
        spark.range(part * 40, part * 40 + 40).selectExpr(
            "'a' AS k", "timestamp_seconds(id * 7) AS time", "id"
        ).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    kept = _drain(stream_min_gap(stream, ["k"], "time", "id", 30), tmp_path, "gap")
    assert sorted(r.id for r in kept.collect()) == list(range(0, 120, 5))
    coarse = stream.withColumn("time", F.date_trunc("hour", "time"))
    changed = _drain(stream_changed(coarse, ["k"], "time", "id"), tmp_path, "changed")
    assert changed.count() == 1
