"""Queries of the line parsers and file readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marinelake.functions.lines import classify_cast_line, detect_format
from marinelake.functions.names import campaign_name, file_type, output_path
from marinelake.functions.nmea import checksum, parse_sentences
from marinelake.functions.values import guessed_value, number
from marinelake.operators.casts import preamble_roles
from marinelake.plans import inputs
from marinelake.plans.inputs import DAY_FILE_SQL, NMEA_BODIES_SQL, NMEA_FIELDS_SQL
from marinelake.plans.registry import bigint, query, shown, shown_sql, table
from marinelake.sources.events import file_events, latest_reading
from marinelake.sources.lines import first_files
from marinelake.sources.tables import (
    cnv_records,
    csv_line_records,
    csv_points,
    csv_records,
    header_cells,
)


@query(
    "detect_format",
    """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN 'nmea' WHEN 'view' THEN 'nmea'
        WHEN 'click' THEN 'csv' WHEN 'signup' THEN CASE WHEN value < 100 THEN 'csv' ELSE 'hex' END
        ELSE 'csv' END AS format
    FROM events
    """,
)
def detect_format_query(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    digits = F.lpad(F.hex("event_id"), 20, "A")
    line = (
        F.when(kind == "purchase", F.format_string(" %s $GNGGA,1,2", F.col("ts").cast("string").substr(12, 8)))
        .when(kind == "view", F.format_string("$GPRMC,%d ", F.col("event_id")))
        .when(kind == "click", F.format_string("%s,%s,$GPGGA", F.col("ts").cast("string"), value))
        .when((kind == "signup") & (value < 100), digits)
        .when(kind == "signup", F.concat(digits, digits, F.lower(digits)))
        .when(value < 30, "# XMLCON_START")
        .when(value < 60, F.concat(F.lit("* "), F.repeat(F.lit("A"), 60)))
        .when(value < 90, F.lit("$PASHR,1"))
        .otherwise("* $GPGGA,1")
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("value"))
    return lines.select("event_id", detect_format(F.col("value")).alias("format"))


def _sentences(spark, sf_dir):
    return parse_sentences(inputs.sentence_lines(spark, sf_dir))


_POSITION_SQL = """
    round(CASE WHEN ns = 'S' THEN -1 ELSE 1 END * (lat_deg + lat_min / 10000.0 / 60), 6) AS latitude,
    round(CASE WHEN ew = 'W' THEN -1 ELSE 1 END * (lon_deg + lon_min / 10000.0 / 60), 6) AS longitude
"""


@query(
    "nmea_gga",
    f"""
    SELECT event_id AS line_ord, {shown_sql('ts')} AS time, {_POSITION_SQL},
           quality AS gps_quality, sats AS num_satellites,
           (sats % 10) / 10.0::DOUBLE AS horizontal_dilution,
           tenths / 10.0::DOUBLE AS gps_antenna_height
    FROM ({NMEA_FIELDS_SQL})
    WHERE event_type = 'purchase' OR (event_type = 'error' AND value >= 300)
    """,
)
def nmea_gga(spark, sf_dir):
    """The bare sentences of the error source take the ingest time."""
    good = _sentences(spark, sf_dir).where(
        F.col("reject_reason").isNull() & (F.col("sentence_type") == "GGA")
    )
    return good.select(
        "line_ord",
        shown("time").alias("time"),
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
        bigint(F.col("gps_quality")).alias("gps_quality"),
        bigint(F.col("num_satellites")).alias("num_satellites"),
        "horizontal_dilution",
        "gps_antenna_height",
    )


@query(
    "nmea_rmc_vtg",
    f"""
    SELECT event_id AS line_ord, CASE WHEN event_type = 'view' THEN 'RMC' ELSE 'VTG' END
               AS sentence_type,
           CASE WHEN event_type = 'view' THEN latitude END AS latitude,
           CASE WHEN event_type = 'view' THEN longitude END AS longitude,
           round(tenths / 10.0 * 0.514444, 6) AS speed_over_ground,
           course / 10.0::DOUBLE AS course_over_ground
    FROM (SELECT *, {_POSITION_SQL} FROM ({NMEA_FIELDS_SQL}))
    WHERE event_type = 'click' OR (event_type = 'view' AND value >= 5)
    """,
)
def nmea_rmc_vtg(spark, sf_dir):
    """Void RMC fixes (status V) carry nothing and are rejected."""
    good = _sentences(spark, sf_dir).where(
        F.col("reject_reason").isNull() & F.col("sentence_type").isin("RMC", "VTG")
    )
    return good.select(
        "line_ord",
        "sentence_type",
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
        F.round("speed_over_ground", 6).alias("speed_over_ground"),
        "course_over_ground",
    )


@query(
    "nmea_zda",
    f"""
    SELECT event_id AS line_ord, {shown_sql('ts')} AS time,
           {shown_sql("date_trunc('second', ts)")} AS gps_utc_time
    FROM events WHERE event_type = 'signup'
    """,
)
def nmea_zda(spark, sf_dir):
    good = _sentences(spark, sf_dir).where(
        F.col("reject_reason").isNull() & (F.col("sentence_type") == "ZDA")
    )
    return good.select(
        "line_ord", shown("time").alias("time"), shown("gps_utc_time").alias("gps_utc_time")
    )


@query(
    "nmea_checksum",
    f"""
    SELECT event_id, body, upper(printf('%02x', CAST(list_reduce(
               list_transform(string_split(body, ''), lambda c: ascii(c)),
               lambda a, b: xor(a, b)) AS INTEGER))) AS checksum
    FROM ({NMEA_BODIES_SQL})
    """,
)
def nmea_checksum(spark, sf_dir):
    bodies = inputs.sentence_bodies(spark, sf_dir)
    return bodies.select("event_id", "body", checksum(F.col("body")).alias("checksum"))


@query(
    "rejects",
    """
    SELECT event_type AS source_file, reason, count(*) AS lines FROM (
        SELECT event_type, CASE
            WHEN event_type = 'view' AND value < 5 THEN 'no_fields'
            WHEN event_type <> 'error' THEN 'none'
            WHEN value < 10 THEN 'blank' WHEN value < 50 THEN 'not_a_sentence'
            WHEN value < 100 THEN 'bad_checksum' WHEN value < 200 THEN 'unsupported_sentence'
            WHEN value < 300 THEN 'bad_time' ELSE 'none' END AS reason
        FROM events) GROUP BY ALL
    """,
)
def rejects(spark, sf_dir):
    reason = F.coalesce("reject_reason", F.lit("none")).alias("reason")
    return (
        _sentences(spark, sf_dir)
        .groupBy("source_file", reason)
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "csv_lines",
    """
    SELECT event_id AS line_ord, CAST(CASE WHEN value < 10 THEN 2 ELSE 3 END AS BIGINT) AS n_cells,
           user_id AS sensor, CASE WHEN value < 10 THEN NULL ELSE value END AS reading,
           CASE WHEN value < 10 THEN NULL WHEN value = floor(value) THEN 'int' ELSE 'float' END
               AS reading_kind,
           event_type AS label
    FROM events WHERE event_type <> 'click'
    """,
)
def csv_lines(spark, sf_dir):
    sensor = F.col("user_id").cast("string")
    cell = F.when(F.col("value") < 10, " ").otherwise(F.col("value").cast("string"))
    cells = F.when(F.col("event_type") == "click", F.concat_ws(",", sensor, cell)).otherwise(
        F.concat_ws(", ", sensor, cell, "event_type")
    )
    lines = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line_ord"), cells.alias("value")
    )
    record = F.col("record")
    reading = guessed_value(record["reading"])
    return csv_line_records(lines, header_cells("sensor, reading ,label")).select(
        "line_ord",
        bigint(F.size(record)).alias("n_cells"),
        bigint(number(record["sensor"])).alias("sensor"),
        reading["num"].alias("reading"),
        F.when(record["reading"].isNotNull(), reading["kind"]).alias("reading_kind"),
        record["label"].alias("label"),
    )


@query(
    "csv_mixed_headers",
    f"""
    SELECT {DAY_FILE_SQL} AS source_file, event_id AS line_ord, {shown_sql('ts')} AS time,
           CASE WHEN track THEN user_id % 90 END::DOUBLE AS latitude,
           CASE WHEN track THEN value END AS depth,
           CASE WHEN value <= 200 THEN value END AS "TEMP",
           NULL::DOUBLE AS "PSAL",
           CASE WHEN NOT track THEN concat(user_id, ',a') END AS device
    FROM (SELECT *, event_type IN ('purchase', 'view') AS track FROM events)
    WHERE value >= 5
    """,
)
def csv_mixed_headers(spark, sf_dir):
    """Every file against its own header; unreadable times drop the row."""
    points = csv_points(csv_records(inputs.mixed_csv_lines(spark, sf_dir)))
    return points.select(
        "source_file",
        "line_ord",
        shown("time").alias("time"),
        "latitude",
        "depth",
        "TEMP",
        "PSAL",
        F.col("extra")["device"].alias("device"),
    )


@query(
    "cnv_profile",
    f"""
    SELECT {DAY_FILE_SQL} AS source_file, event_id AS line_ord,
           CASE WHEN event_type IN ('view', 'click') THEN event_id ELSE user_id END::DOUBLE AS latitude,
           CASE WHEN event_type IN ('view', 'click') THEN value * 2 ELSE value END AS "depSM",
           CASE WHEN event_type IN ('view', 'click') THEN value ELSE value * 2 END AS "t090C",
           CASE WHEN event_type IN ('view', 'click') THEN user_id ELSE event_id END::DOUBLE AS c0
    FROM events
    """,
)
def cnv_profile(spark, sf_dir):
    records = cnv_records(inputs.cnv_lines(spark, sf_dir))
    record = F.col("record")
    return records.select(
        "source_file",
        "line_ord",
        *[number(record[c]).alias(c) for c in ("latitude", "depSM", "t090C")],
        number(record["c0S/m"]).alias("c0"),
    )


@query(
    "classify_hex_lines",
    """
    WITH streams AS (SELECT DISTINCT event_type AS source_file FROM events),
    preamble AS (
        SELECT source_file, unnest([-1000, -999, -998, -997, -996, -995, -994, -993]) AS line_ord,
               unnest(['header', 'xmlcon_start', 'xmlcon', 'xmlcon', 'xmlcon_end', 'header',
                       'header_end', 'ignore']) AS role
        FROM streams)
    SELECT source_file, line_ord, role FROM preamble
    UNION ALL
    SELECT event_type, event_id, CASE WHEN value < 10 THEN 'ignore' ELSE 'scan' END FROM events
    """,
)
def classify_hex_lines(spark, sf_dir):
    """A preamble with a calibration block at the head of every stream."""
    data = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_file"),
        F.col("event_id").alias("line_ord"),
        F.when(F.col("value") < 10, "junk").otherwise(
            F.lpad(F.hex("event_id"), 82, "0")
        ).alias("value"),
    )
    preamble = F.array(
        *map(
            F.lit,
            ["* Sea-Bird", "# XMLCON_START", "# <Instrument>", "#</Instrument>", "# XMLCON_END",
             "# datcnv", "*END*", "* late"],
        )
    )
    lines = inputs.with_preamble(data, preamble, ["source_file"])
    return preamble_roles(lines).select("source_file", "line_ord", "role")


@query(
    "scan_lines_by_role",
    """
    SELECT event_type AS source_file, CASE WHEN value < 10 THEN 'header' WHEN value < 20 THEN
        'comment' WHEN value < 40 THEN 'ignore' ELSE 'scan' END AS role, count(*) AS lines
    FROM events GROUP BY ALL
    """,
)
def scan_lines_by_role(spark, sf_dir):
    value = F.col("value")
    line = (
        F.when(value < 10, "* x").when(value < 20, "#x").when(value < 40, "ABCDEF")
        .otherwise(F.lpad(F.hex("event_id"), 41, "0"))
    )
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_type").alias("source_file"), classify_cast_line(line).alias("role"))
        .groupBy("source_file", "role")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


_SUFFIXES = [".txt", ".CSV", ".geocsv", ".hex", ".CNV", ".raw", ".ad2cp", ".tar.gz", ".TGZ", ".dat"]
_FAMILIES = ["nmea", "csv", "csv", "hex", "cnv", "adcp", "ad2cp", "archive", "archive", "csv"]


@query(
    "route_files",
    f"""
    SELECT p_partkey, {_FAMILIES}[p_size % {len(_FAMILIES)} + 1] AS file_type FROM part
    """,
)
def route_files_query(spark, sf_dir):
    suffix = F.get(F.array(*map(F.lit, _SUFFIXES)), F.col("p_size") % len(_SUFFIXES))
    path = F.concat(F.lit("/data/"), "p_brand", F.lit("/"), "p_name", suffix)
    return table(spark, sf_dir, "part").select("p_partkey", file_type(path).alias("file_type"))


@query(
    "first_files",
    """
    SELECT event_id, event_type, path FROM (
        SELECT event_id, event_type, concat(event_type, '/', user_id, '.csv') AS path FROM events)
    WHERE path IN (SELECT DISTINCT concat(event_type, '/', user_id, '.csv') AS p FROM events
                   ORDER BY p LIMIT 100)
    """,
)
def first_files_query(spark, sf_dir):
    """The rows of the first hundred files: a top-k over the listing, then a semi join."""
    path = F.concat("event_type", F.lit("/"), F.col("user_id").cast("string"), F.lit(".csv"))
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", path.alias("path"))
    return rows.join(first_files(rows.select("path").distinct(), 100), "path", "left_semi").select(
        "event_id", "event_type", "path"
    )


@query(
    "file_events",
    """
    SELECT event_id, CASE WHEN event_type <> 'purchase' THEN 'skipped'
        WHEN value < 20 THEN 'error' WHEN NOT known THEN 'error' ELSE 'queued' END AS status,
        CASE WHEN event_type <> 'purchase' THEN concat('event=', event_type)
        WHEN value < 20 THEN 'file not found: '
        WHEN NOT known THEN concat('file not found: /data/', user_id, '.csv') END AS reason,
        CASE WHEN value >= 20 THEN concat('/data/', user_id, '.csv') END AS file
    FROM (SELECT *, user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS known
          FROM events)
    """,
)
def file_events_query(spark, sf_dir):
    """Messages with either path key, checked against a listing of known files."""
    events = table(spark, sf_dir, "events")
    path = F.format_string("/data/%d.csv", F.col("user_id"))
    kind = F.when(F.col("event_type") == "purchase", "fileadd").otherwise(F.col("event_type"))
    message = (
        F.when(F.col("value") < 20, F.to_json(F.struct(kind.alias("event"))))
        .when(
            F.col("value") < 50,
            F.to_json(F.struct(kind.alias("event"), path.alias("path"), F.col("event_id").alias("size"))),
        )
        .otherwise(F.to_json(F.struct(kind.alias("event"), path.alias("file_added_path"))))
    )
    known = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") > 0)
        .select(F.format_string("/data/%d.csv", F.col("c_custkey")).alias("path"))
    )
    messages = events.select("event_id", message.alias("value"))
    return file_events(messages, known=known).select("event_id", "status", "reason", "file")


@query(
    "latest_reading",
    f"""
    WITH firsts AS (SELECT user_id, arg_min(struct_pack(ts, value, event_type), event_id) AS r
                    FROM events GROUP BY user_id)
    SELECT concat('reading_', user_id, '.csv') AS source_file, {shown_sql('r.ts')} AS time,
           r.value AS temperature, NULL::DOUBLE AS salinity, r.value * 2 AS pressure,
           r.event_type AS site, 'ctd_latest' AS source, 'ctd_csv' AS file_type
    FROM firsts
    """,
)
def latest_reading_query(spark, sf_dir):
    """First row of each device's file under a header of mixed case."""
    data = table(spark, sf_dir, "events").select(
        F.format_string("reading_%d.csv", F.col("user_id")).alias("source_file"),
        F.col("event_id").alias("line_ord"),
        F.concat_ws(
            ",", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            F.col("value").cast("string"), F.lit("n/a"), (F.col("value") * 2).cast("string"),
            "event_type",
        ).alias("value"),
    )
    header = F.array(F.lit("Timestamp,Temperature,SALINITY, Pressure,Site"))
    readings = latest_reading(inputs.with_preamble(data, header, ["source_file"]))
    return readings.select(
        "source_file", shown("time").alias("time"), "temperature", "salinity", "pressure",
        F.col("extra")["site"].alias("site"), "source", "file_type",
    )


_NAME_SQL = """
    CASE WHEN s = '' THEN 'default' WHEN length(s) < 3 THEN rpad(s, 3, '0') ELSE s END
"""


@query(
    "sanitize_names",
    f"""
    WITH texts AS (SELECT url AS name FROM pages UNION ALL SELECT p_name FROM part
                   UNION ALL SELECT p_brand FROM part
                   UNION ALL SELECT concat('--', CAST(p_size AS VARCHAR), '_') FROM part
                   UNION ALL SELECT repeat('_', p_size) FROM part)
    SELECT name, {_NAME_SQL} AS campaign FROM (
        SELECT name, trim(substr(trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9-]', '-',
            'g'), '-{{2,}}', '-', 'g'), '-'), 1, 63), '-') AS s FROM texts)
    """,
)
def sanitize_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = (
        table(spark, sf_dir, "pages").select(F.col("url").alias("name"))
        .unionAll(part.select("p_name"))
        .unionAll(part.select("p_brand"))
        .unionAll(part.select(F.concat(F.lit("--"), F.col("p_size").cast("string"), F.lit("_"))))
        .unionAll(part.select(F.repeat(F.lit("_"), F.col("p_size"))))
    )
    return names.select("name", campaign_name(F.col("name")).alias("campaign"))


@query(
    "output_layout",
    """
    SELECT event_id, concat('cruise-', event_type, '/sensordata/', strftime(ts, '%Y-%m-%d'),
                            '/track.', user_id, '.parquet') AS output_path
    FROM events
    """,
)
def output_layout(spark, sf_dir):
    path = F.concat(F.lit("/in/track."), F.col("user_id").cast("string"), F.lit(".csv"))
    campaign = F.concat(F.lit("Cruise: "), "event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        output_path(campaign, F.lit("sensordata"), F.col("ts"), path).alias("output_path"),
    )
