"""Scan decoding, calibration, salinity, depth and ensembles against known values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marinelake.operators.casts import with_coefficients
from marinelake.operators.sequence import moving_average
from marinelake.plans.ingest import cast_points
from marinelake.functions import seawater
from marinelake.operators.casts import decode_scans
from marinelake.operators.currents import adcp_ensembles, echo_or_velocity
from marinelake.sources.casts import parse_calibration, parse_header
from tests.test_lines import SCAN


def _decode(spark, scan, freq=0, volt=0, position=True, time=True):
    df = spark.createDataFrame(
        [(scan, freq, volt, position, time)],
        "hex_scan STRING, frequency_channels_suppressed INT, voltage_words_suppressed INT, "
        "nmea_position_added BOOLEAN, scan_time_added BOOLEAN",
    )
    return decode_scans(df).first()


def test_known_scan(spark):
    row = _decode(spark, SCAN)
    assert row.temperature_freq == 4592.72265625
    assert row.conductivity_freq == 2895.51953125
    assert row.pressure_freq == 33191.59765625
    assert (row.temperature2_freq, row.conductivity2_freq) == (4691.875, 2650.3515625)
    volts = [round(row[f"volt{i}"], 4) for i in range(8)]
    assert volts == [0.0147, 4.7863, 1.2564, 1.8877, 4.9683, 0.0, 1.4396, 0.0]
    assert (row.scan_latitude, row.scan_longitude) == (30.0, -160.636)
    assert (row.temperature_comp, row.status, row.modulo) == (0x912, 2, 0x93)
    assert row.scan_time == datetime(2022, 6, 16, 18, 16, 32)


def test_suppressed_channels_shift_offsets(spark):
    short = SCAN[:18] + SCAN[30:48] + SCAN[68:74]
    row = _decode(spark, short, freq=2, volt=1, position=False, time=False)
    assert row.pressure_freq == 33191.59765625
    assert row.temperature2_freq is None and row.volt6 is None
    assert round(row.volt5, 4) == 0.0
    assert (row.temperature_comp, row.scan_time, row.scan_latitude) == (0x912, None, None)


def test_short_scan_gives_nulls(spark):
    row = _decode(spark, SCAN[:40])
    assert row.temperature_freq == 4592.72265625
    assert row.scan_latitude is None and row.scan_time is None


@pytest.mark.parametrize(
    "ratio, t, p, expected",
    [(1.0, 15.0, 0.0, 35.0), (1.888091, 40.0, 10000.0, 40.0), (1.2, 20.0, 2000.0, 37.245628),
     (0.65, 5.0, 1500.0, 27.995347)],
)
def test_salinity_check_values(spark, ratio, t, p, expected):
    df = spark.createDataFrame([(ratio, t, p)], "r DOUBLE, t DOUBLE, p DOUBLE")
    got = df.select(seawater.salinity_from_ratio(F.col("r"), F.col("t"), F.col("p"))).first()[0]
    assert got == pytest.approx(expected, abs=1e-5)


@pytest.mark.parametrize("p, lat, expected", [(10000.0, 30.0, 9712.653), (5000.0, 0.0, 4915.04)])
def test_depth_check_values(spark, p, lat, expected):
    df = spark.createDataFrame([(p, lat)], "p DOUBLE, lat DOUBLE")
    got = df.select(seawater.depth(F.col("p"), F.col("lat"))).first()[0]
    assert got == pytest.approx(expected, abs=0.01)


def test_header(spark):
    text = (
        "* Sea-Bird\n* NMEA Latitude = 30 00.00 N\n* NMEA Longitude = 160 38.16 W\n"
        "* NMEA UTC (Time) = Jun 16 2022  18:16:30\n** Station: 11901 \n"
        "* Number of Bytes Per Scan = 41\n"
    )
    row = parse_header(spark.createDataFrame([(text,), ("",)], "content STRING")).collect()
    assert row[0].hdr_latitude == 30.0
    assert row[0].hdr_longitude == pytest.approx(-160.636)
    assert row[0].start_time == datetime(2022, 6, 16, 18, 16, 30)
    assert (row[0].station, row[0].bytes_per_scan, row[0].voltage_words) == ("11901", 41, None)
    assert all(v is None for v in row[1])


def test_malformed_calibration_gives_defaults(spark):
    df = spark.createDataFrame([("<SBE><Instrument",), ("plain",)], "content STRING")
    for row in parse_calibration(df).collect():
        assert row.sensors == [] and row.frequency_channels_suppressed == 0
        assert not row.nmea_position_added and not row.secondary_temperature


def _pings(spark, corr):
    beams = [[1.0, 2.0], [0.5, 1.0], [0.0, 0.0], [0.2, 0.4]]
    row = ("f", datetime(2024, 1, 1, 0, 0, 30), 350.0, 0.0, 0.0, 10.0, [4.0, 8.0], beams,
           [[corr, 100.0]] * 4, [[50.0, 60.0]] * 4)
    late = ("f", datetime(2024, 1, 1, 0, 1, 59), 10.0, 0.0, 0.0, 12.0, *row[6:])
    schema = (
        "source_file STRING, time TIMESTAMP, heading DOUBLE, pitch DOUBLE, roll DOUBLE, temp DOUBLE, "
        "range ARRAY<DOUBLE>, vel ARRAY<ARRAY<DOUBLE>>, corr ARRAY<ARRAY<DOUBLE>>, "
        "amp ARRAY<ARRAY<DOUBLE>>"
    )
    return spark.createDataFrame([row, late], schema)


def test_ensembles(spark):
    rows = adcp_ensembles(_pings(spark, 63.9)).orderBy("cell").collect()
    assert [(r.depth, r.num_pings, r.temperature) for r in rows] == [(11.0, 2, 11.0), (15.0, 2, 11.0)]
    assert rows[0].u is None and rows[1].u is not None
    assert min(rows[0].heading, 360 - rows[0].heading) == pytest.approx(0.0, abs=1e-9)
    assert adcp_ensembles(_pings(spark, 64.0)).where("u IS NULL").count() == 0


def test_echo_or_velocity(spark):
    echo = spark.createDataFrame([("a", 1.0)], "source_file STRING, sv DOUBLE")
    velocity = spark.createDataFrame([("a", 2.0), ("b", 3.0)], "source_file STRING, u DOUBLE")
    rows = echo_or_velocity(echo, velocity).orderBy("source_file").collect()
    assert [tuple(r) for r in rows] == [("a", 1.0, None), ("b", None, 3.0)]


def _salinity(ratio, t, p=0.0):
    """Salinity from the ratio in plain numbers, with the extension below 2."""
    rp = 1 + p * (2.070e-5 - 6.370e-10 * p + 3.989e-15 * p * p) / (1 + 3.426e-2 * t + 4.464e-4 * t * t + (4.215e-1 - 3.107e-3 * t) * ratio)
    rt = ratio / (rp * sum(c * t**i for i, c in enumerate([0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9])))
    bend = (t - 15) / (1 + 0.0162 * (t - 15))
    a, b = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081), (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
    whole = sum((x + bend * y) * rt ** (i / 2) for i, (x, y) in enumerate(zip(a, b)))
    x, y = 400 * rt, 100 * rt
    return whole if whole >= 2 else whole - a[0] / (1 + 1.5 * x + x * x) - b[0] * bend / (1 + y**0.5 + y + y**1.5)


def test_low_salinity(spark):
    rows = [(r / 1000, t) for r in (0, 1, 5, 20, 40, 50, 60, 100) for t in (0.0, 7.5, 15.0, 30.0)]
    df = spark.createDataFrame(rows, "r DOUBLE, t DOUBLE").withColumn("p", F.lit(0.0))
    got = df.select("r", "t", seawater.salinity_from_ratio(F.col("r"), F.col("t"), F.col("p")).alias("s")).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.s == pytest.approx(_salinity(row.r, row.t), abs=1e-9)
        # Without conductivity there is no salt; the branches meet within 0.005 at 2.
        assert row.r > 0 or row.s == pytest.approx(0, abs=1e-12)


def test_moving_average_across_blocks(spark):
    values = {"a": [(i * 37) % 11 if i % 5 else None for i in range(50)], "b": [3.0], "c": [float(i) for i in range(8)]}
    rows = [(k, i + 1, None if v is None else float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k STRING, n BIGINT, v DOUBLE").repartition(3)
    for before, after, block in ((2, 3, 4), (9, 0, 4), (0, 1, 1), (100, 100, 7)):
        got = {(r.k, r.n): r.m for r in moving_average(df, ["k"], "n", "v", before, after, "m", block).collect()}
        assert len(got) == len(rows)
        for k, vs in values.items():
            for i in range(len(vs)):
                near = [v for v in vs[max(0, i - before) : i + after + 1] if v is not None]
                assert got[k, i + 1] == (pytest.approx(sum(near) / len(near)) if near else None)


def test_smoothed_pressure_of_a_cast(spark, tmp_path):
    """In the job, a spike of the compensation count is spread over the scans around it."""
    def scan(i):
        return "11F0B8" * 5 + "000" * 8 + "16E3607A8C2040" + ("FFF" if i == 30 else "800") + "293" + "60AAAB62"

    lines = "\n".join(scan(i) for i in range(60))
    df = spark.createDataFrame([("d/one.hex", i, v) for i, v in enumerate(lines.split("\n"))], "source_file STRING, line_ord BIGINT, value STRING")
    cal = {"C1": "-42000", "C2": "-0.5", "C3": "0.014", "D1": "0.038", "D2": "0", "T1": "30.3", "T2": "-3e-4", "T3": "4e-6", "T4": "3e-9"}
    sensors = F.array(F.struct(F.lit("PressureSensor").alias("type"), F.create_map(*[F.lit(x) for kv in cal.items() for x in kv]).alias("coefficients")))
    casts = spark.range(1).select(
        F.lit("d").alias("dir"), F.lit("one").alias("stem_lc"), F.lit("d/one.xmlcon").alias("source_file"), F.lit(0).alias("frequency_channels_suppressed"),
        F.lit(0).alias("voltage_words_suppressed"), F.lit(True).alias("nmea_position_added"), F.lit(True).alias("scan_time_added"), sensors.alias("sensors"),
    )
    headers = parse_header(spark.createDataFrame([], "dir STRING, stem_lc STRING, source_file STRING, content STRING"))
    got = cast_points(df, headers, with_coefficients(casts)).orderBy("scan").collect()
    pressures = {round(r.pressure, 9) for r in got}
    assert [r.scan for r in got] == list(range(1, 61)) and got[0].temperature_comp == 0x800
    # All 60 scans lie within 15 s of each other, so all have one mean.
    assert len(pressures) == 1 and got[0].salinity2 is None
