"""Sensor-shaped inputs derived from the given tables.

``events`` is the sensor stream: the user is the device, the event type the
source. Text formats the tables lack are rendered from their columns and parsed
back, so that the expected result follows from the original columns. Each
rendering has its SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.nmea import checksum
from marinelake.functions.values import computed_once
from marinelake.plans.registry import table

_OBSERVATIONS = {
    "source_file": "concat(event_type, '.csv')",
    "device": "user_id",
    "line_ord": "event_id",
    "event_type": "event_type",
    "latitude": "CASE WHEN event_type <> 'signup' AND value >= 10 "
    "THEN user_id % 90 + value / 1000 END",
    "longitude": "CASE WHEN event_type <> 'signup' AND value < 300 "
    "THEN user_id % 180 - 90 + value / 1000 END",
    "depth": "CASE WHEN value > 1 THEN value END",
    "TEMP": "CASE WHEN event_type <> 'error' THEN 2 + value / 50 END",
    "PSAL": "CASE WHEN event_type <> 'click' THEN 30 + value / 100 END",
    "CNDC": "CASE WHEN value < 500 THEN 3 + value / 200 END",
    "speed_over_ground": "CASE WHEN event_type = 'view' THEN value / 10 END",
}

OBSERVATIONS_SQL = (
    "SELECT "
    + ", ".join(f'{expr} AS "{name}"' for name, expr in _OBSERVATIONS.items())
    + ", ts AS time FROM events"
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        *[F.expr(expr).alias(name) for name, expr in _OBSERVATIONS.items()],
        F.col("ts").cast("timestamp").alias("time"),
    )


# One file per source and day.
DAY_FILE_SQL = "concat(event_type, '_', strftime(ts, '%Y%m%d'), '.csv')"


def day_file(event_type: str = "event_type", time: str = "ts") -> Column:
    return F.concat(F.col(event_type), F.lit("_"), F.date_format(time, "yyyyMMdd"), F.lit(".csv"))


# --- GNSS sentences -------------------------------------------------------
# Minutes are whole ten-thousandths, so that the rendering is exact.

NMEA_FIELDS_SQL = """
    SELECT event_id, event_type, value, ts,
           user_id % 90 AS lat_deg, user_id % 180 AS lon_deg,
           (event_id * 7919) % 600000 AS lat_min, (event_id * 104729) % 600000 AS lon_min,
           CASE WHEN value < 100 THEN 'S' ELSE 'N' END AS ns,
           CASE WHEN value < 40 THEN 'E' ELSE 'W' END AS ew,
           event_id % 9 AS quality, user_id % 24 AS sats,
           CAST(floor(value) AS BIGINT) AS tenths,
           (event_id * 31) % 3600 AS course
    FROM events
"""

NMEA_BODIES_SQL = f"""
    SELECT *, CASE
      WHEN event_type = 'view' THEN
        concat('GPRMC,', strftime(ts, '%H%M%S'), '.00,', CASE WHEN value < 5 THEN 'V' ELSE 'A' END,
               printf(',%02d%02d.%04d,%s,%03d%02d.%04d,%s,%d.%d,%d.%d,', lat_deg, lat_min // 10000,
                      lat_min % 10000, ns, lon_deg, lon_min // 10000, lon_min % 10000, ew,
                      tenths // 10, tenths % 10, course // 10, course % 10),
               strftime(ts, '%d%m%y'), ',11.0,E')
      WHEN event_type = 'click' THEN
        printf('GPVTG,%d.%d,T,303.1,M,%d.%d,N,0.046,K', course // 10, course % 10,
               tenths // 10, tenths % 10)
      WHEN event_type = 'signup' THEN
        concat('GPZDA,', strftime(ts, '%H%M%S'), '.00,', strftime(ts, '%d,%m,%Y'), ',00,00')
      ELSE
        concat('GPGGA,', strftime(ts, '%H%M%S'), '.00',
               printf(',%02d%02d.%04d,%s,%03d%02d.%04d,%s,%d,%d,0.%d,%d.%d', lat_deg,
                      lat_min // 10000, lat_min % 10000, ns, lon_deg, lon_min // 10000,
                      lon_min % 10000, ew, quality, sats, sats % 10, tenths // 10, tenths % 10),
               ',M,-34.3,M,,')
      END AS body
    FROM ({NMEA_FIELDS_SQL})
"""


def _minutes(column: str) -> list[Column]:
    return [F.floor(F.col(column) / 10000), F.col(column) % 10000]


def _tenths(column: str) -> list[Column]:
    return [F.floor(F.col(column) / 10), F.col(column) % 10]


def sentence_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, event_type, value, ts, body``: RMC, VTG, ZDA and GGA by event type."""
    fields = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "value", "ts",
        "user_id % 90 AS lat_deg", "user_id % 180 AS lon_deg",
        "(event_id * 7919) % 600000 AS lat_min", "(event_id * 104729) % 600000 AS lon_min",
        "CASE WHEN value < 100 THEN 'S' ELSE 'N' END AS ns",
        "CASE WHEN value < 40 THEN 'E' ELSE 'W' END AS ew",
        "event_id % 9 AS quality", "user_id % 24 AS sats",
        "CAST(floor(value) AS BIGINT) AS tenths",
        "(event_id * 31) % 3600 AS course",
    )
    clock = F.date_format("ts", "HHmmss")
    position = [F.col("lat_deg"), *_minutes("lat_min"), F.col("ns"),
                F.col("lon_deg"), *_minutes("lon_min"), F.col("ew")]
    shape = "%02d%02d.%04d,%s,%03d%02d.%04d,%s"
    rmc = F.format_string(
        f"GPRMC,%s.00,%s,{shape},%d.%d,%d.%d,%s,11.0,E", clock,
        F.when(F.col("value") < 5, "V").otherwise("A"), *position,
        *_tenths("tenths"), *_tenths("course"), F.date_format("ts", "ddMMyy"),
    )
    vtg = F.format_string(
        "GPVTG,%d.%d,T,303.1,M,%d.%d,N,0.046,K", *_tenths("course"), *_tenths("tenths")
    )
    zda = F.format_string("GPZDA,%s.00,%s,00,00", clock, F.date_format("ts", "dd,MM,yyyy"))
    gga = F.format_string(
        f"GPGGA,%s.00,{shape},%d,%d,0.%d,%d.%d,M,-34.3,M,,", clock, *position,
        F.col("quality"), F.col("sats"), F.col("sats") % 10, *_tenths("tenths"),
    )
    kind = F.col("event_type")
    body = F.when(kind == "view", rmc).when(kind == "click", vtg).when(kind == "signup", zda)
    return computed_once(fields, {"body": body.otherwise(gga)}).select(
        "event_id", "event_type", "value", "ts", "body"
    )


def sentence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with time prefix and checksum; the ``error`` source sends broken lines."""
    bodies = sentence_bodies(spark, sf_dir).withColumn("_sum", checksum(F.col("body")))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    good = F.format_string("%s $%s*%s", stamp, F.col("body"), F.col("_sum"))
    value = F.col("measure")
    broken = (
        F.when(value < 10, "   ")
        .when(value < 50, "not a valid nmea sentence")
        .when(value < 100, F.format_string("%s $%s1*%s", stamp, F.col("body"), F.col("_sum")))
        .when(value < 200, F.format_string("%s $GPGSV,3,1,11,03,03,111,00", stamp))
        .when(value < 300, F.format_string("soon $%s*%s", F.col("body"), F.col("_sum")))
        .otherwise(F.format_string("$%s*%s", F.col("body"), F.col("_sum")))
    )
    line = F.when(F.col("event_type") == "error", broken).otherwise(good)
    return computed_once(bodies.withColumnRenamed("value", "measure"), {"value": line}).select(
        F.col("event_type").alias("source_file"),
        F.col("event_id").alias("line_ord"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
        "value",
    )


# --- CSV and CNV files ----------------------------------------------------

CSV_LAYOUTS = {
    "track": "time,latitude,longitude,depth,TEMP",
    "mooring": "device, TEMP,PSAL ,time",
}


def csv_layout(event_type: Column) -> Column:
    return F.when(event_type.isin("purchase", "view"), "track").otherwise("mooring")


def with_preamble(data: DataFrame, preamble: Column, keys: list[str]) -> DataFrame:
    """Data lines of each file after an array of header lines, numbered below zero."""
    files = data.select(*keys).distinct()
    heads = files.select(*keys, F.posexplode(preamble).alias("_at", "value")).select(
        *keys, (F.col("_at").cast("bigint") - 1000).alias("line_ord"), "value"
    )
    return heads.unionByName(data.select(*keys, "line_ord", "value"))


def mixed_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts, with comments, a quoted cell, bad times and bad numbers."""
    events = table(spark, sf_dir, "events")
    stamp = F.when(F.col("value") < 5, "sometime").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    temp = F.when(F.col("value") > 200, "n/a").otherwise(F.col("value").cast("string"))
    device = F.col("user_id").cast("string")
    track = F.concat_ws(
        ",", stamp, (F.col("user_id") % 90).cast("string"), F.lit(""),
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")), temp,
    )
    mooring = F.concat_ws(
        ",", F.concat(F.lit('"'), device, F.lit(',a"')), temp, F.lit("inf"), stamp
    )
    layout = csv_layout(F.col("event_type"))
    data = events.select(
        day_file().alias("source_file"),
        layout.alias("layout"),
        F.col("event_id").alias("line_ord"),
        F.when(layout == "track", track).otherwise(mooring).alias("value"),
    )
    header = F.when(F.col("layout") == "track", CSV_LAYOUTS["track"]).otherwise(
        CSV_LAYOUTS["mooring"]
    )
    lines = with_preamble(
        data, F.array(F.lit("# a comment"), header), ["source_file", "layout"]
    )
    return lines.drop("layout")


CNV_COLUMNS = [
    "latitude: Latitude [deg]",
    "depSM: Depth [salt water, m]",
    "t090C: Temperature [ITS-90, deg C]",
    "c0S/m: Conductivity [S/m]",
]


def cnv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with a header; every second family has its columns in reverse."""
    data = table(spark, sf_dir, "events").select(
        day_file().alias("source_file"),
        F.col("event_type").isin("view", "click").alias("reverse"),
        F.col("event_id").alias("line_ord"),
        F.format_string(
            "  %d  %s\t%s  %d", F.col("user_id"), F.col("value").cast("string"),
            (F.col("value") * 2).cast("string"), F.col("event_id"),
        ).alias("value"),
    )

    def header(columns: list[str]) -> Column:
        names = [f"# name {i} = {c}" for i, c in enumerate(columns)]
        return F.array(
            *map(F.lit, ["* Sea-Bird SBE 9 Data File:", "# nquan = 4", *names, "*END*"])
        )

    preamble = F.when(F.col("reverse"), header(CNV_COLUMNS[::-1])).otherwise(header(CNV_COLUMNS))
    return with_preamble(data, preamble, ["source_file", "reverse"]).drop("reverse")


# --- CTD scans ------------------------------------------------------------

SCAN_FIELDS_SQL = """
    SELECT l_orderkey, l_linenumber, l_returnflag,
           (l_orderkey * 4111 + l_linenumber) % 16777216 AS f0,
           (l_partkey * 7919) % 16777216 AS f1,
           (l_suppkey * 15485863) % 16777216 AS f2,
           (l_orderkey * 31 + l_partkey) % 16777216 AS f3,
           (l_partkey * 17 + l_suppkey) % 16777216 AS f4,
           l_partkey % 4096 AS v0, l_suppkey % 4096 AS v1, l_orderkey % 4096 AS v2,
           (l_orderkey * 3) % 4500000 AS lat, (l_partkey * 431) % 9000000 AS lon,
           CASE WHEN l_linestatus = 'F' THEN 128 ELSE 0 END
             + CASE WHEN l_quantity > 25 THEN 64 ELSE 0 END AS sign,
           (l_partkey * 13) % 4096 AS comp, l_linenumber % 16 AS status, l_suppkey % 256 AS modulo,
           CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber AS seconds
    FROM lineitem
"""


def scan_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag",
        "(l_orderkey * 4111 + l_linenumber) % 16777216 AS f0",
        "(l_partkey * 7919) % 16777216 AS f1",
        "(l_suppkey * 15485863) % 16777216 AS f2",
        "(l_orderkey * 31 + l_partkey) % 16777216 AS f3",
        "(l_partkey * 17 + l_suppkey) % 16777216 AS f4",
        "l_partkey % 4096 AS v0", "l_suppkey % 4096 AS v1", "l_orderkey % 4096 AS v2",
        "(l_orderkey * 3) % 4500000 AS lat", "(l_partkey * 431) % 9000000 AS lon",
        "CASE WHEN l_linestatus = 'F' THEN 128 ELSE 0 END "
        "+ CASE WHEN l_quantity > 25 THEN 64 ELSE 0 END AS sign",
        "(l_partkey * 13) % 4096 AS comp", "l_linenumber % 16 AS status",
        "l_suppkey % 256 AS modulo",
        "unix_seconds(CAST(l_shipdate AS TIMESTAMP)) + l_linenumber AS seconds",
    )


def hex_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans of three layouts, by return flag, with the flags of their calibration.

    ``A`` is complete, ``N`` lacks one voltage word and the position, ``R`` two
    frequency words and the time.
    """
    def digits(column: Column, width: int) -> Column:
        return F.lpad(F.hex(column), width, "0")

    frequencies = [digits(F.col(f"f{i}"), 6) for i in range(5)]
    voltages = [digits(F.col(f"v{i % 3}"), 3) for i in range(8)]
    position = F.concat(digits(F.col("lat"), 6), digits(F.col("lon"), 6), digits(F.col("sign"), 2))
    status = F.concat(
        digits(F.col("comp"), 3), digits(F.col("status"), 1), digits(F.col("modulo"), 2)
    )
    seconds = digits(F.col("seconds"), 8)
    time = F.concat(*[F.substring(seconds, 7 - 2 * i, 2) for i in range(4)])
    flag = F.col("l_returnflag")
    scan = (
        F.when(flag == "A", F.concat(*frequencies, *voltages, position, status, time))
        .when(flag == "N", F.concat(*frequencies, *voltages[:6], status, time))
        .otherwise(F.concat(*frequencies[:3], *voltages, position, status))
    )
    return computed_once(scan_fields(spark, sf_dir), {"hex_scan": scan}).select(
        "l_orderkey",
        "l_linenumber",
        "hex_scan",
        F.when(flag == "R", 2).otherwise(0).alias("frequency_channels_suppressed"),
        F.when(flag == "N", 1).otherwise(0).alias("voltage_words_suppressed"),
        (flag != "N").alias("nmea_position_added"),
        (flag != "R").alias("scan_time_added"),
    )


def header_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cast header per customer; some lack a field."""
    key = F.col("c_custkey")
    text = F.format_string(
        "* Sea-Bird SBE 9 Data File:\n* NMEA Latitude = %02d %02d.%02d %s\n"
        "* NMEA Longitude = %03d %02d.%02d %s\n* NMEA UTC (Time) = %s\n%s"
        "* Number of Bytes Per Scan = %d\n* Number of Voltage Words = %d\n*END*\n",
        key % 90, key % 60, key % 100, F.when(F.col("c_acctbal") < 0, "S").otherwise("N"),
        key % 180, key % 59, key % 100, F.when(F.col("c_nationkey") < 12, "W").otherwise("E"),
        F.date_format(F.timestamp_seconds(key * 86399), "MMM dd yyyy  HH:mm:ss"),
        F.when(
            F.col("c_mktsegment") != "MACHINERY",
            F.concat(F.lit("** Station: "), F.col("c_name"), F.lit(" \n")),
        ).otherwise(""),
        key % 50 + 20, F.col("c_nationkey") % 5,
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("content"))


def calibration_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calibration per supplier; low balances give malformed XML."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    second = F.when(
        nation < 12, '<Sensor index="3" SensorID="55"><TemperatureSensor SensorID="55">'
        "<SerialNumber>9</SerialNumber><G>1</G></TemperatureSensor></Sensor>",
    ).otherwise('<Sensor index="3" SensorID="27"><NotInUse SensorID="27"/></Sensor>')
    text = F.format_string(
        '<?xml version="1.0"?><SBE_InstrumentConfiguration><Instrument Type="8">'
        "<FrequencyChannelsSuppressed>%d</FrequencyChannelsSuppressed>"
        "<VoltageWordsSuppressed>%d</VoltageWordsSuppressed>"
        "<NmeaPositionDataAdded>%d</NmeaPositionDataAdded><ScanTimeAdded>1</ScanTimeAdded>"
        '<SensorArray Size="4"><Sensor index="0" SensorID="55"><TemperatureSensor SensorID="55">'
        "<SerialNumber>%d</SerialNumber><G>%d.5</G><H>2.0e-4</H><F0>1000.0</F0>"
        '</TemperatureSensor></Sensor><Sensor index="1" SensorID="3"><ConductivitySensor>'
        "<SerialNumber>7</SerialNumber><!-- two blocks -->"
        '<Coefficients equation="0"><G>-1</G><CPcor>-1</CPcor></Coefficients>'
        '<Coefficients equation="1"><G>%d.25</G><CPcor>-9.57e-8</CPcor></Coefficients>'
        '</ConductivitySensor></Sensor><Sensor index="2" SensorID="45"><PressureSensor>'
        "<C1>%d</C1></PressureSensor></Sensor>%s</SensorArray></Instrument>%s",
        nation % 3, nation % 4, nation % 2, key, key, nation, key * 2, second,
        F.when(F.col("s_acctbal") < 0, "<broken").otherwise("</SBE_InstrumentConfiguration>"),
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("content"))


# --- ADCP pings -----------------------------------------------------------

CELLS = 16


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ping per vector: four beams of 16 cells from its 64 components."""
    def beam(number: int) -> Column:
        part = F.slice(F.col("embedding"), number * CELLS + 1, CELLS)
        return F.transform(part, lambda x: x.cast("double"))

    beams = F.array(*[beam(b) for b in range(4)])
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("adcp_"), F.col("label"), F.lit(".raw")).alias("source_file"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 10).alias("time"),
        (F.lit(10.0) + (F.col("vec_id") * 7) % 160).alias("heading"),
        ((F.col("vec_id") % 11) / 10).alias("pitch"),
        ((F.col("vec_id") % 7) / 10).alias("roll"),
        (F.lit(5.0) + (F.col("vec_id") % 100) / 10).alias("temp"),
        F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda i: i * 8.0 + 4.0).alias("range"),
        beams.alias("vel"),
        F.transform(beams, lambda b: F.transform(b, lambda x: F.abs(x) * 600.0)).alias("corr"),
        F.transform(beams, lambda b: F.transform(b, lambda x: F.abs(x) * 100.0)).alias("amp"),
    )
