"""Queries of the live streams, each over several micro-batches.

A turn writes a part of the rows and runs the stream over what is new from the same
checkpoint, so that a turn is one micro-batch and every turn a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.options import JobOptions
from marinelake.plans import inputs
from marinelake.plans.registry import query, shown, shown_sql, table
from marinelake.plans.stream_ingest import csv_stream, point_batches, run_batches, scan_batches, sentence_batches, window_batches
from marinelake.session import scratch_dir
from marinelake.streaming.commits import Commits, published_table
from marinelake.streaming.lines import broker_lines, stream_lines
from marinelake.streaming.sequences import stream_batches, stream_scans

OPTIONS = JobOptions(campaign_id="Test Cruise 7", platform_id="ship-1", provider="auto")
Writer = Callable[[DataFrame, int], None]


def in_turns(
    rows: DataFrame, turn: Column, turns: int, save: Callable[[DataFrame, str], None], read: Callable[[str], DataFrame], run: Callable[[DataFrame], None]
) -> None:
    """Write the rows of each turn into one folder, then run the stream on it."""
    folder = scratch_dir(rows.sparkSession, "turns")
    rows = rows.withColumn("in_turn", turn).persist()
    for k in range(turns):
        save(rows.where(F.col("in_turn") == k).drop("in_turn"), f"{folder}/turn={k}")
        run(read(folder))
    rows.unpersist()


def repeated(writer: Writer) -> Writer:
    """Every micro-batch comes twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        writer(batch, batch_id)

    return write


def _stubborn(writer: Writer, out: str, source: str) -> Writer:
    """Every micro-batch fails once after its data are written, and comes twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lost = batch.select(F.lit("lost").alias("source_file"), F.lit("x").alias("value"))
        Commits(batch.sparkSession, out, source).write_tables(batch_id, {"data": lost, "rejects": lost})
        repeated(writer)(batch, batch_id)

    return write


# --- stream ingest --------------------------------------------------------

_TURN_SQL = "event_id % 3"


@query(
    "stream_ingest",
    f"""
    WITH lines AS (
        SELECT *, {_TURN_SQL} AS turn, CASE
            WHEN event_type = 'view' AND value < 5 THEN 'no_fields'
            WHEN event_type <> 'error' THEN NULL
            WHEN value < 10 THEN 'blank' WHEN value < 50 THEN 'not_a_sentence'
            WHEN value < 100 THEN 'bad_checksum' WHEN value < 200 THEN 'unsupported_sentence'
            WHEN value < 300 THEN 'bad_time' END AS reason
        FROM events
    ), kept AS (  -- bare sentences all take the time of their file, and the first is kept
        SELECT DISTINCT turn, event_type, CASE WHEN event_type <> 'error' THEN ts END AS time FROM lines WHERE reason IS NULL
    )
    SELECT 'data' AS part, event_type AS name, count(*) AS n, {shown_sql('min(time)')} AS time_min,
           {shown_sql('max(time)')} AS time_max FROM kept GROUP BY event_type
    UNION ALL SELECT 'rejects', reason, count(*), NULL, NULL FROM lines WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'results', concat(turn, ' ok'), count(*), NULL, NULL FROM kept GROUP BY turn
    UNION ALL SELECT 'telemetry', concat(turn, ' stream Test Cruise 7 ship-1'), count(*), NULL, NULL FROM kept GROUP BY turn
    """,
)
def stream_ingest(spark, sf_dir):
    """Sentences in three micro-batches, each of which fails once and comes twice."""
    out, checkpoint = scratch_dir(spark, "live"), scratch_dir(spark, "live-state")
    lines = inputs.sentence_lines(spark, sf_dir).withColumnRenamed("source_file", "kind")
    writer = _stubborn(sentence_batches(out, OPTIONS, "gnss"), out, "gnss")
    in_turns(
        lines, F.col("line_ord") % 3, 3,
        # One file per type and turn, in the order of the lines.
        lambda rows, path: rows.repartition("kind").sortWithinPartitions("kind", "line_ord").select("kind", "value").write.partitionBy("kind").text(path),
        lambda folder: stream_lines(spark, folder, "*.txt"),
        lambda stream: run_batches(stream, writer, checkpoint),
    )
    kind = F.regexp_extract("source_file", "kind=([a-z]*)", 1)
    at = F.when(kind != "error", F.col("time"))
    data = published_table(spark, out, "data", "gnss").groupBy(F.lit("data").alias("part"), kind.alias("name")).agg(
        F.count(F.lit(1)).alias("n"), shown(F.min(at)).alias("time_min"), shown(F.max(at)).alias("time_max")
    )
    none = [F.lit(None).cast("string").alias(c) for c in ("time_min", "time_max")]
    rejects = published_table(spark, out, "rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    results = published_table(spark, out, "results").select(F.concat_ws(" ", F.col("batch_id").cast("string"), "status"), "record_count")
    said = F.from_json("value", "source STRING, campaign_id STRING, platform_id STRING, record_count BIGINT")
    sent = published_table(spark, out, "telemetry").select("key", said.alias("m")).select(
        F.concat_ws(" ", "key", "m.source", "m.campaign_id", "m.platform_id"), "m.record_count"
    )
    parts = [("rejects", rejects), ("results", results), ("telemetry", sent)]
    for part, rows in parts:
        data = data.unionByName(rows.toDF("name", "n").select(F.lit(part).alias("part"), "name", "n", *none))
    return data


# --- lines of a broker ----------------------------------------------------

MESSAGE = "key STRING, offset BIGINT, value BINARY, timestamp TIMESTAMP"


def broker_messages(rows: DataFrame, key: Column, offset: Column, value: Column, turn: Column) -> DataFrame:
    """Rows as a broker gives them, and the turn they arrive in."""
    return rows.select(
        key.cast("string").alias("key"), offset.cast("bigint").alias("offset"), value.cast("binary").alias("value"),
        F.timestamp_seconds(F.lit(1704067200)).alias("timestamp"), turn.alias("turn"),
    )


def broker_turns(messages: DataFrame, turns: int, run: Callable[[DataFrame], None]) -> None:
    spark = messages.sparkSession
    in_turns(
        messages, F.col("turn"), turns,
        lambda rows, path: rows.drop("turn").write.parquet(path),
        lambda folder: broker_lines(spark.readStream.schema(MESSAGE).parquet(folder)),
        run,
    )


@query(
    "stream_csv",
    f"""
    WITH lines AS (
        SELECT *, CASE WHEN value < 10 THEN 'cell_count' WHEN value < 20 THEN 'bad_time' END AS reason
        FROM events
    )
    SELECT 'data' AS part, event_type AS name, event_id AS line_ord, {shown_sql('ts')} AS time,
           CASE WHEN event_type IN ('purchase', 'view') THEN user_id::DOUBLE END AS latitude,
           CASE WHEN value <= 200 THEN value END AS temp, user_id::VARCHAR AS device
    FROM lines WHERE reason IS NULL
    UNION ALL SELECT reason, event_type, event_id, NULL, NULL, NULL, NULL FROM lines WHERE reason IS NOT NULL
    """,
)
def stream_csv(spark, sf_dir):
    """Streams whose headers come before their data, two micro-batches after it began, or
    again with the columns in another order."""
    out, checkpoint = scratch_dir(spark, "csv"), scratch_dir(spark, "csv-state")
    events = table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), F.col("value")
    stamp = F.when(value.between(10, 20) & (value != 20), "sometime").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    temp = F.when(value > 200, "n/a").otherwise(value.cast("string"))
    place = F.when(kind.isin("purchase", "view"), F.col("user_id").cast("string")).otherwise("")
    turn = F.col("event_id") % 3
    cells = [F.col("user_id").cast("string"), stamp, place, temp]
    # In the last turn the columns of one stream are reversed.
    turned = (kind == "view") & (turn == 2)
    line = F.when(turned, F.concat_ws(" , ", *cells[::-1])).otherwise(F.concat_ws(",", *cells))
    line = F.when(value < 10, F.concat(line, F.lit(",more"))).otherwise(line)
    data = broker_messages(events, kind, F.col("event_id"), line, turn)
    heads = events.select("event_type").distinct().select(
        "event_type", F.explode(F.array(F.when(kind == "click", 2).otherwise(0), F.when(kind == "view", 2))).alias("at")
    ).where("at is not null")
    names = F.when((kind == "view") & (F.col("at") == 2), "TEMP, latitude, time, device").otherwise("device,time,latitude,TEMP")
    header = broker_messages(heads, kind, F.lit(-1), names, F.col("at"))
    noise = broker_messages(heads.where("at = 0"), kind, F.lit(-2), F.lit("# a comment"), F.lit(1))
    writer = point_batches(out, OPTIONS, "csv")
    broker_turns(
        data.unionByName(header).unionByName(noise), 3,
        lambda lines: run_batches(csv_stream(lines), repeated(writer), checkpoint),
    )
    records = published_table(spark, out, "data", "csv").select(
        F.lit("data").alias("part"), F.col("source_file").alias("name"), "line_ord", shown("time").alias("time"),
        "latitude", F.col("TEMP").alias("temp"), F.col("extra")["device"].alias("device"),
    )
    none = F.lit(None).cast("string")
    return records.unionByName(published_table(spark, out, "rejects", "csv").select(
        F.col("reject_reason").alias("part"), F.col("source_file").alias("name"), "line_ord", none.alias("time"),
        none.cast("double").alias("latitude"), none.cast("double").alias("temp"), none.alias("device"),
    ))


_SCAN_TURN_SQL = "l_linenumber % 3"


@query(
    "stream_hex",
    f"""
    WITH scans AS (
        SELECT *, {_SCAN_TURN_SQL} AS turn, l_orderkey % 4 AS device FROM ({inputs.SCAN_FIELDS_SQL}) WHERE l_returnflag = 'A'
    )
    SELECT concat('device-', device) AS device, NULL AS scans,
           CASE WHEN known THEN f0 / 256.0 END AS temperature_freq, CASE WHEN known THEN f2 / 256.0 END AS pressure_freq,
           CASE WHEN known THEN round(1 / (0.004 + CASE WHEN device = 2 AND turn = 2 THEN 0.001 ELSE 0 END + 0.0006 * ln(1000 / (f0 / 256.0))) - 273.15, 6) END AS temperature,
           CASE WHEN known AND device = 0 THEN 'Station 0' END AS station
    FROM (SELECT *, device <> 3 AND (device <> 1 OR turn > 0) AS known FROM scans) WHERE f0 > 0
    UNION ALL SELECT concat('last of ', device), count(*), NULL, NULL, NULL, NULL FROM scans GROUP BY device
    UNION ALL SELECT 'rejects', count(DISTINCT device) * 2, NULL, NULL, NULL, NULL FROM scans
    """,
)
def stream_hex(spark, sf_dir):
    """Scans of four devices in three micro-batches: the preamble comes first, one
    micro-batch after the first scans, first and then with another calibration, or never."""
    out, checkpoint = scratch_dir(spark, "scans"), scratch_dir(spark, "scans-state")
    turn = F.col("l_linenumber") % 3
    device = F.col("l_orderkey") % 4
    scans = inputs.hex_scans(spark, sf_dir).where("scan_time_added and nmea_position_added")
    # Offsets that keep the scans in order below 2^53, after the lines of the preamble.
    place = (turn.cast("bigint") * (1 << 42)) + F.col("l_orderkey") * 8 + F.col("l_linenumber") + (1 << 20)
    data = broker_messages(scans, F.concat(F.lit("device-"), device), place, F.lower("hex_scan"), turn)

    def calibration(g: float) -> list[str]:
        xml = (
            '<SBE_InstrumentConfiguration><Instrument><FrequencyChannelsSuppressed>0</FrequencyChannelsSuppressed>',
            '<VoltageWordsSuppressed>0</VoltageWordsSuppressed><NmeaPositionDataAdded>1</NmeaPositionDataAdded>',
            '<ScanTimeAdded>1</ScanTimeAdded><SensorArray><Sensor index="0" SensorID="55"><TemperatureSensor SensorID="55">',
            f'<G>{g}</G><H>0.0006</H><I>0</I><J>0</J><F0>1000</F0></TemperatureSensor></Sensor></SensorArray>',
            '</Instrument></SBE_InstrumentConfiguration>',
        )
        return ["# XMLCON_START", *[f"# {line}" for line in xml], "# XMLCON_END"]

    header = ["* Sea-Bird SBE 9 Data File:", "** Station: Station 0"]
    preambles = {(0, 0): [*header, *calibration(0.004), "*END*"], (1, 1): [*calibration(0.004), "*END*"],
                 (2, 0): [*calibration(0.004), "*END*"], (2, 2): calibration(0.005)}
    lines = [(f"device-{d}", (t << 42) + i, line, t) for (d, t), text in preambles.items() for i, line in enumerate(text)]
    lines += [(f"device-{d}", (t << 42) + 1000, "no scan", t) for d in range(4) for t in (0, 1)]
    about = spark.createDataFrame(lines, "k string, o bigint, v string, t int")
    # Only devices that have scans.
    about = about.join(data.select(F.col("key").alias("k")).distinct(), "k", "left_semi")
    messages = data.unionByName(broker_messages(about, F.col("k"), F.col("o"), F.col("v"), F.col("t")))
    writer = scan_batches(out, OPTIONS)
    broker_turns(messages, 3, lambda rows: run_batches(stream_scans(rows, ["source_file"]), repeated(writer), checkpoint))
    data = published_table(spark, out, "data")
    none = [F.lit(None).cast("double").alias(c) for c in ("temperature_freq", "pressure_freq", "temperature")]
    station = F.lit(None).cast("string").alias("station")
    found = data.where(~F.col("hex_scan").startswith("000000")).select(
        F.col("source_file").alias("device"), F.lit(None).cast("bigint").alias("scans"), "temperature_freq", "pressure_freq",
        F.round("temperature", 6).alias("temperature"), "station",
    )
    # Numbered from 1 on without a gap: the last number is how many there are.
    last = data.groupBy(F.replace("source_file", F.lit("device-"), F.lit("last of ")).alias("device")).agg(
        F.when(F.count_distinct("scan") == F.max("scan"), F.max("scan")).alias("scans")
    )
    rejects = published_table(spark, out, "rejects").agg(F.lit("rejects").alias("device"), F.count(F.lit(1)).alias("scans"))
    return found.union(last.unionByName(rejects).select("device", "scans", *none, station))


@query(
    "stream_batches",
    """
    WITH RECURSIVE numbered AS (
        SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    walk AS (
        SELECT user_id, event_id, ts, n, ts AS start, 1 AS place, 1 AS batch_no FROM numbered WHERE n = 1
        UNION ALL
        SELECT r.user_id, r.event_id, r.ts, r.n,
               CASE WHEN w.place = 4 OR r.ts >= w.start + INTERVAL 36 HOUR THEN r.ts ELSE w.start END,
               CASE WHEN w.place = 4 OR r.ts >= w.start + INTERVAL 36 HOUR THEN 1 ELSE w.place + 1 END,
               CASE WHEN w.place = 4 OR r.ts >= w.start + INTERVAL 36 HOUR THEN w.batch_no + 1 ELSE w.batch_no END
        FROM walk w JOIN numbered r ON r.user_id = w.user_id AND r.n = w.n + 1),
    mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 12 HOUR AS mark FROM events),
    batches AS (
        SELECT user_id, batch_no, min(start) AS start, max(place) AS size, max(ts) AS last FROM walk GROUP BY ALL)
    SELECT user_id, event_id, batch_no, strftime(b.start, '%Y-%m-%d %H:%M:%S.%f') AS batch_start,
           CASE WHEN size = 4 THEN 'count' ELSE 'time' END AS closed_by
    FROM walk JOIN batches b USING (user_id, batch_no), mark
    WHERE (size = 4 AND b.last < mark) OR b.start + INTERVAL 36 HOUR <= mark
    """,
)
def stream_batches_query(spark, sf_dir):
    """Batches of 4 records or 36 hours over five micro-batches, a tenth of the records
    one micro-batch late, though within the watermark's delay."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    out, checkpoint = scratch_dir(spark, "batches"), scratch_dir(spark, "batches-state")
    # A record is late only if it comes just before its turn ends.
    hour = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    late = (F.col("event_id") % 10 == 0) & (hour % 192 >= 184)
    in_turns(
        events, F.floor(hour / 192) + F.when(late, 1).otherwise(0), 5,
        lambda rows, path: rows.write.parquet(path),
        lambda folder: spark.readStream.schema(events.schema).parquet(folder).select(*events.columns),
        lambda stream: stream_batches(stream, ["user_id"], "ts", "event_id", 36 * 3600, 4, "12 hours").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination(),
    )
    return spark.read.parquet(out).select(
        "user_id", "event_id", "batch_no", shown("batch_start").alias("batch_start"), "closed_by"
    )


# --- late records ---------------------------------------------------------

DELAY_HOURS, WINDOW_HOURS = 6, 4
_LATE_TURN_SQL = "(day(ts) - 1) // 8 + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END"


@query(
    "late_records",
    f"""
    WITH arrived AS (SELECT *, {_LATE_TURN_SQL} AS turn FROM events),
    marks AS (SELECT turn, max(max(ts)) OVER (ORDER BY turn) - INTERVAL {DELAY_HOURS} HOUR AS mark FROM arrived GROUP BY turn),
    judged AS (SELECT a.*, coalesce(a.ts < m.mark, false) AS late FROM arrived a LEFT JOIN marks m ON m.turn = a.turn - 1)
    SELECT 'late' AS part, event_type, {shown_sql('ts')} AS time, event_id AS n, value AS largest FROM judged WHERE late
    UNION ALL
    SELECT 'window', event_type, {shown_sql(f"time_bucket(INTERVAL {WINDOW_HOURS} HOUR, ts, TIMESTAMP '1970-01-01')")} AS start,
           count(*), max(value)
    FROM judged
    WHERE NOT late AND time_bucket(INTERVAL {WINDOW_HOURS} HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL {WINDOW_HOURS} HOUR
          <= (SELECT max(mark) FROM marks)
    GROUP BY ALL
    """,
)
def late_records(spark, sf_dir):
    """Every twentieth record comes one micro-batch late."""
    out, checkpoint = scratch_dir(spark, "windows"), scratch_dir(spark, "windows-state")
    events = table(spark, sf_dir, "events")
    turn = F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("event_id") % 20 == 0, 1).otherwise(0)
    writer = window_batches(out, ["event_type"], WINDOW_HOURS * 3600, DELAY_HOURS * 3600)

    in_turns(
        events, turn, 5,
        lambda rows, path: rows.write.parquet(path),
        lambda folder: spark.readStream.schema(events.schema).parquet(folder).select(
            "event_type", "event_id", F.col("ts").alias("time"), F.col("value").alias("latitude"), F.col("value").alias("longitude")
        ),
        lambda stream: run_batches(stream, repeated(writer), checkpoint),
    )
    late = published_table(spark, out, "rejects").select(
        F.lit("late").alias("part"), "event_type", shown("time").alias("time"), F.col("event_id").alias("n"), F.col("latitude").alias("largest")
    )
    windows = published_table(spark, out, "windows").select(
        F.lit("window").alias("part"), "event_type", shown("window_start").alias("time"), F.col("record_count").alias("n"), F.col("lat_max").alias("largest")
    )
    return late.unionByName(windows)
