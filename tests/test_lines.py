"""Line parsers on inline samples with exact values."""

from datetime import datetime
from functools import reduce
from operator import xor

import pytest
from pyspark.sql import functions as F

from marinelake.functions.lines import detect_format
from marinelake.functions.names import campaign_name, file_type, stem
from marinelake.functions.nmea import checksum, parse_sentences
from marinelake.functions.values import guessed_value
from marinelake.operators.casts import preamble_roles
from marinelake.sources.events import file_events, latest_reading
from marinelake.sources.tables import (
    cnv_records,
    csv_line_records,
    csv_points,
    csv_records,
    header_cells,
)

# Fixed value: a published sample scan whose decoded fields are known.
SCAN = "11F0B90B4F8581A7991253E00A5A5AFF30AFBFA9F501AFFFB64FFF16E3607A8E38409122938073AB62"


def sentence(body):
    """A sentence with the checksum that belongs to it."""
    return f"${body}*{reduce(xor, body.encode()):02X}"


FIX = "GPGGA,181500.50,5512.3000,S,06743.8000,W,2,7,1.3,21.5,M,12.0,M,,"
COURSE = "GPVTG,87.5,T,92.0,M,10.0,N,18.5,K"
WHEN = "2022-11-05T18:15:00.75Z"


@pytest.mark.parametrize(
    "line, expected",
    [
        (SCAN, "hex"),
        (f"\t{SCAN.lower()}", "hex"),
        (SCAN[:12], "csv"),
        (sentence(FIX), "nmea"),
        (f"{WHEN} ${FIX}", "nmea"),
        ("$GLGSV,1,1,00*65", "nmea"),
        (f"two words ${FIX}", "csv"),
        (f"# ${FIX}", "csv"),
        ("time;depth", "csv"),
        (f"{WHEN},-55.2,-67.7,3.5", "csv"),
        ("* header of a cast", "csv"),
        ("# comment", "csv"),
    ],
)
def test_detect_format(lines, line, expected):
    assert lines([line]).select(detect_format(F.col("value"))).first()[0] == expected


def _parse(lines, line):
    return parse_sentences(lines([line])).first()


def test_fix(lines):
    row = _parse(lines, f"{WHEN} {sentence(FIX)}")
    assert row.reject_reason is None and row.checksum_ok
    assert row.latitude == pytest.approx(-(55 + 12.3 / 60))
    assert row.longitude == pytest.approx(-(67 + 43.8 / 60))
    assert (row.gps_quality, row.num_satellites) == (2, 7)
    assert (row.horizontal_dilution, row.gps_antenna_height) == (1.3, 21.5)
    assert row.time == datetime(2022, 11, 5, 18, 15, 0, 750000)


def test_speed_course_and_clock(lines):
    rmc = _parse(lines, f"{WHEN} {sentence('GPRMC,181501.00,A,5512.3000,N,06743.8000,E,4.0,271.5,051122,3.0,E')}")
    assert rmc.speed_over_ground == pytest.approx(4 * 1852 / 3600, abs=1e-4)
    assert (rmc.course_over_ground, rmc.latitude) == (271.5, pytest.approx(55.205))
    vtg = _parse(lines, sentence(COURSE))
    assert vtg.speed_over_ground == pytest.approx(10 * 1852 / 3600, abs=1e-4)
    assert vtg.course_over_ground == 87.5
    # A bare sentence has the time at which it was received.
    assert vtg.time == datetime(2020, 1, 1)
    zda = _parse(lines, f"{WHEN} {sentence('GPZDA,181502.00,05,11,2022,00,00')}")
    assert zda.gps_utc_time == datetime(2022, 11, 5, 18, 15, 2)


@pytest.mark.parametrize(
    "line, reason",
    [
        ("", "blank"),
        (" \t ", "blank"),
        ("ship log, page 3", "not_a_sentence"),
        (f"${FIX}*00", "bad_checksum"),
        (sentence("GLGSV,1,1,00"), "unsupported_sentence"),
        (f"noon {sentence(COURSE)}", "bad_time"),
        ("$GPZDA,,,,,,", "no_fields"),
        ("$GPRMC,181501.00,V,5512.3000,N,06743.8000,E,4.0,271.5,051122,3.0,E", "no_fields"),
    ],
)
def test_rejects(lines, line, reason):
    assert _parse(lines, line).reject_reason == reason


def test_checksum_absent_is_accepted(lines):
    assert _parse(lines, f"${COURSE}").reject_reason is None


def test_checksum(lines):
    assert lines([COURSE]).select(checksum(F.col("value"))).first()[0] == sentence(COURSE)[-2:]


def test_csv_line_records(lines):
    got = csv_line_records(
        lines(["sensor_1,hello,5.0", "1,2", "", " , , ", "a, ,b"]), header_cells("id, name ,n")
    )
    assert [r.record for r in got.orderBy("line_ord").collect()] == [
        {"id": "sensor_1", "name": "hello", "n": "5.0"},
        {"id": "a", "n": "b"},
    ]


def test_repeated_header_keeps_last(lines):
    got = csv_line_records(lines(["1,2"]), ["x", "x"]).first()
    assert got.record == {"x": "2"}


@pytest.mark.parametrize(
    "text, kind, num",
    [("5.0", "int", 5.0), ("5.5", "float", 5.5), ("nan", "string", None),
     ("inf", "string", None), ("hello", "string", None), ("1e3", "int", 1000.0)],
)
def test_guessed_value(lines, text, kind, num):
    got = lines([text]).select(guessed_value(F.col("value")).alias("v")).first().v
    assert (got.kind, got.num) == (kind, num)
    assert got.text == (text if num is None else None)


def test_csv_file_with_comments_and_quotes(lines):
    rows = csv_records(
        lines(
            ["# made by hand", "", "time,latitude,note,TEMP",
             '2023-06-01T00:00:00Z,41.18,"a, ""b""",17.5', "not a time,1,x,2",
             "2023-06-01T00:30:00Z,x", "2023-06-01T00:40:00Z,1,2,3,4"]
        )
    )
    assert [r.line_ord for r in rows.where("reject_reason = 'too_many_cells'").collect()] == [6]
    points = csv_points(rows).orderBy("line_ord").collect()
    assert [(p.latitude, p.TEMP, p.extra) for p in points] == [
        (41.18, 17.5, {"note": 'a, "b"'}),
        (None, None, {}),
    ]


def test_csv_without_time_keeps_rows(lines):
    points = csv_points(csv_records(lines(["TEMP,depth", "1,2", "3,4"])))
    assert points.count() == 2


def test_header_only_gives_no_rows(lines):
    assert csv_points(csv_records(lines(["time,latitude,longitude"]))).count() == 0


def test_cnv(lines):
    text = [
        "* Sea-Bird SBE 9 Data File:", "# nquan = 2", "# name 0 = latitude: Latitude [deg]",
        "# name 1 = c0S/m: Conductivity [S/m]", "*END*", "   30.00000   4.5000", "  31.0\t4.6 ",
    ]
    rows = cnv_records(lines(text)).orderBy("line_ord").collect()
    assert [r.record for r in rows] == [
        {"latitude": "30.00000", "c0S/m": "4.5000"},
        {"latitude": "31.0", "c0S/m": "4.6"},
    ]
    assert cnv_records(lines(["*END*", "1 2"])).count() == 0


def test_preamble_roles(lines):
    text = ["* head", "# XMLCON_START", "# <a>", "*x", "# XMLCON_END", "# more", "*END*",
            "* late", SCAN, "junk"]
    roles = preamble_roles(lines(text)).orderBy("line_ord").collect()
    assert [r.role for r in roles] == [
        "header", "xmlcon_start", "xmlcon", "xmlcon", "xmlcon_end", "header", "header_end",
        "ignore", "scan", "ignore",
    ]


def test_file_events(lines, spark):
    messages = lines(
        ['{"event": "fileadd", "file_added_path": "/d/a.csv", "size": 3}',
         '{"event": "fileadd", "path": "/d/b.csv"}', '{"event": "fileadd"}',
         '{"event": "other"}', "not json"]
    )
    known = spark.createDataFrame([("/d/a.csv",)], "path STRING")
    got = file_events(messages, known=known).orderBy("line_ord").collect()
    assert [r.status for r in got] == ["queued", "error", "error", "skipped", "skipped"]
    assert got[3].reason == "event=other"
    assert file_events(messages).where("status = 'queued'").count() == 2


def test_latest_reading(lines):
    rows = lines([" Timestamp,Temperature,Salinity,Site", "2024-01-01T00:00:00Z,7.5,x,a", "later,1,2,b"])
    got = latest_reading(rows).collect()
    assert len(got) == 1
    assert (got[0].temperature, got[0].salinity, got[0].extra) == (7.5, None, {"site": "a"})
    assert (got[0].source, got[0].file_type) == ("ctd_latest", "ctd_csv")
    assert latest_reading(lines(["Temperature", "3"])).count() == 0


@pytest.mark.parametrize(
    "name, expected",
    [("RR2205", "rr2205"), ("My Cruise 2024!", "my-cruise-2024"), ("--a--", "a00"), ("", "default"),
     (None, "default"), ("___", "default"), ("ab", "ab0"), ("x" * 70, "x" * 63),
     ("y" * 62 + "- z", "y" * 62)],
)
def test_campaign_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n STRING")
    assert df.select(campaign_name(F.col("n"))).first()[0] == expected


@pytest.mark.parametrize(
    "path, family, name",
    [("/a/x.TXT", "nmea", "x"), ("/a/x.tar.gz", "archive", "x.tar"), ("/a.b/y", "csv", "y"),
     ("c.AD2CP", "ad2cp", "c"), ("d.raw", "adcp", "d"), ("e.geocsv", "csv", "e")],
)
def test_file_type_and_stem(spark, path, family, name):
    df = spark.createDataFrame([(path,)], "p STRING")
    assert tuple(df.select(file_type(F.col("p")), stem(F.col("p"))).first()) == (family, name)
