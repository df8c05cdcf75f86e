"""Queries of the sinks, the whole ingest job and the streams."""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.options import JobOptions
from marinelake.operators import metadata
from marinelake.paths import arrow_filesystem
from marinelake.plans import inputs
from marinelake.plans.ingest import ingest_directory
from marinelake.plans.inputs import NMEA_FIELDS_SQL, OBSERVATIONS_SQL
from marinelake.plans.line_queries import _POSITION_SQL
from marinelake.plans.record_queries import GAP_HOURS, gap_sql
from marinelake.plans.registry import query, shown, shown_sql, table
from marinelake.session import scratch_dir
from marinelake.sinks.geoparquet import write_geoparquet
from marinelake.sinks.tables import current_table, metadata_table, telemetry, write_table
from marinelake.sources.archives import read_archives
from marinelake.sources.lines import list_files, outputs_below
from marinelake.streaming.lines import (
    stream_batch_results,
    stream_lines,
    stream_readings,
    stream_sentences,
)
from marinelake.streaming.state import stream_changed, stream_min_gap

OPTIONS = JobOptions(campaign_id="Test Cruise 7", platform_id="ship-1", provider="auto")
OBS = f"WITH obs AS ({OBSERVATIONS_SQL})"


# --- sinks ----------------------------------------------------------------


def _written(spark: SparkSession, sf_dir: str) -> str:
    """Observations written as partitioned Parquet, by their own day."""
    path = scratch_dir(spark, "table")
    write_table(inputs.observations(spark, sf_dir), path, OPTIONS, day=F.col("time"))
    return path


@query(
    "sink_roundtrip",
    f"""{OBS}
    SELECT 'test-cruise-7' AS campaign, 'sensordata' AS dataset,
           strftime(time, '%Y-%m-%d') AS ingest_date, source_file, line_ord, latitude, "TEMP"
    FROM (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS ok,
                 bool_or(latitude IS NOT NULL AND longitude IS NOT NULL)
                     OVER (PARTITION BY source_file) AS any_ok FROM obs)
    WHERE ok OR NOT any_ok
    """,
)
def sink_roundtrip(spark, sf_dir):
    return spark.read.parquet(_written(spark, sf_dir)).select(
        "campaign", "dataset", F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"),
        "source_file", "line_ord", "latitude", "TEMP",
    )


@query(
    "list_outputs",
    """SELECT DISTINCT concat('campaign=test-cruise-7/dataset=sensordata/ingest_date=',
              strftime(ts, '%Y-%m-%d')) AS folder FROM events""",
)
def list_outputs(spark, sf_dir):
    path = _written(spark, sf_dir)
    listed = outputs_below(list_files(spark, path), path, ".parquet")
    folder = F.regexp_extract("path", r"(campaign=[^/]*/dataset=[^/]*/ingest_date=[^/]*)/", 1)
    return listed.where(F.col("length") > 0).select(folder.alias("folder")).distinct()


@query(
    "geo_points",
    f"""{OBS}
    SELECT source_file, line_ord, latitude, longitude,
           CASE WHEN latitude + longitude IS NOT NULL THEN 21::BIGINT END AS wkb_bytes,
           CASE WHEN latitude + longitude IS NOT NULL THEN '0101000000' END AS wkb_head
    FROM obs WHERE latitude + longitude IS NOT NULL
       OR source_file NOT IN (SELECT source_file FROM obs WHERE latitude + longitude IS NOT NULL)
    """,
)
def geo_points(spark, sf_dir):
    """Points written as GeoParquet and read back."""
    path = scratch_dir(spark, "geo")
    rows = inputs.observations(spark, sf_dir).select(
        "source_file", "line_ord", "latitude", "longitude"
    )
    write_geoparquet(rows, path)
    return spark.read.parquet(path).select(
        "source_file", "line_ord", "latitude", "longitude",
        F.length("geometry").cast("bigint").alias("wkb_bytes"),
        F.substring(F.hex("geometry"), 1, 10).alias("wkb_head"),
    )


@query(
    "telemetry_records",
    gap_sql()
    + """SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts_text, value AS temperature,
                'Test Cruise 7' AS campaign_id, 'ship-1' AS platform_id
         FROM walk JOIN (SELECT event_id, value, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_text
                         FROM events) USING (event_id) WHERE kept""",
)
def telemetry_records(spark, sf_dir):
    """Throttled records as JSON messages, read back field by field."""
    from marinelake.operators.throttle import downsample_min_gap

    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    kept = downsample_min_gap(rows, ["user_id"], "ts", "event_id", GAP_HOURS * 3600)
    messages = telemetry(kept, OPTIONS, "user_id")
    fields = F.from_json(
        "value",
        "event_id BIGINT, ts STRING, value DOUBLE, campaign_id STRING, platform_id STRING",
    )
    return messages.select("key", fields.alias("m")).select(
        "key", "m.event_id", F.substring("m.ts", 1, 19).alias("ts_text"),
        F.col("m.value").alias("temperature"), "m.campaign_id", "m.platform_id",
    )


@query(
    "summary_json",
    """
    SELECT event_type AS key, count(*) AS record_count, min(value) AS lat_min,
           max(value) AS lat_max, 'auto' AS provider
    FROM events GROUP BY event_type
    """,
)
def summary_json(spark, sf_dir):
    """Batch results as JSON messages, read back field by field."""
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("time"),
        F.col("value").alias("latitude"), F.col("value").alias("longitude"),
    )
    messages = telemetry(
        metadata.batch_results(rows, ["event_type"]), OPTIONS, "event_type", summary=True
    )
    fields = F.from_json(
        "value", "record_count BIGINT, lat_min DOUBLE, lat_max DOUBLE, provider STRING"
    )
    return messages.select("key", fields.alias("m")).select("key", "m.*")


@query(
    "metadata_documents",
    f"""{OBS}
    SELECT source_file, count(*) AS record_count, min("TEMP") AS temp_min,
           max("PSAL") AS psal_max, round(avg(depth), 6) AS depth_mean
    FROM obs GROUP BY source_file
    """,
)
def metadata_documents(spark, sf_dir):
    """The metadata sink as JSON, read back."""
    path = scratch_dir(spark, "metadata")
    metadata_table(inputs.observations(spark, sf_dir)).write.json(path)
    stat = "STRUCT<min: DOUBLE, max: DOUBLE, mean: DOUBLE>"
    schema = f"source_file STRING, record_count BIGINT, sensor_stats MAP<STRING, {stat}>"
    stats = F.col("sensor_stats")
    return spark.read.schema(schema).json(path).select(
        "source_file", "record_count",
        stats["TEMP"]["min"].alias("temp_min"),
        stats["PSAL"]["max"].alias("psal_max"),
        F.round(stats["depth"]["mean"], 6).alias("depth_mean"),
    )


# --- archives and the whole job -------------------------------------------


def _archive_writer(folder: str):
    """Each task packs its Arrow batches as members of one archive of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = arrow_filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        name = f"{base}/{uuid.uuid4().hex}.tar.gz"
        members = 0
        with filesystem.open_output_stream(name, compression=None) as raw, tarfile.open(
            fileobj=raw, mode="w|gz"
        ) as tar:
            for batch in batches:
                data = "\n".join(batch.column("value").to_pylist()).encode()
                for member in (f"in/part{members}.csv", f"in/part{members}.md", f"../p{members}.csv"):
                    info = tarfile.TarInfo(member)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
                members += 1
        yield pa.RecordBatch.from_pydict({"name": [name], "members": [members]})

    return run


@query(
    "archive_members",
    "SELECT event_id, user_id, value AS measure FROM events",
)
def archive_members(spark, sf_dir):
    """Rows packed into archives by Spark, then scanned; unsafe and foreign members fall away."""
    folder = scratch_dir(spark, "archives")
    lines = table(spark, sf_dir, "events").select(
        F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                    F.col("value").cast("string")).alias("value")
    )
    packed = lines.repartition(4).mapInArrow(
        _archive_writer(folder), "name STRING, members BIGINT"
    )
    packed.write.format("noop").mode("overwrite").save()
    cells = F.split("value", ",")
    return read_archives(spark, folder).select(
        cells[0].cast("bigint").alias("event_id"),
        cells[1].cast("bigint").alias("user_id"),
        cells[2].cast("double").alias("measure"),
    )


@query(
    "ingest_job",
    f"""
    SELECT 'csv' AS file_type, count(*) AS records, {shown_sql('min(ts)')} AS time_min,
           {shown_sql('max(ts)')} AS time_max
    FROM events WHERE value >= 5
    UNION ALL
    SELECT 'nmea', count(*), {shown_sql('min(ts)')}, {shown_sql('max(ts)')}
    FROM events WHERE event_type IN ('purchase', 'click', 'signup')
                      OR (event_type = 'view' AND value >= 5)
    """,
)
def ingest_job(spark, sf_dir):
    """CSV and sentence files written by Spark, then taken in by one job."""
    source, out = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    stamp = F.when(F.col("value") < 5, "sometime").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    events = table(spark, sf_dir, "events")
    events.select(
        "event_type", stamp.alias("time"), F.lit(41.2).alias("latitude"),
        F.lit(1.8).alias("longitude"), F.col("value").alias("TEMP"),
    ).write.partitionBy("event_type").option("header", True).csv(f"{source}/csv")
    sentences = inputs.sentence_lines(spark, sf_dir)
    sentences.where(F.col("source_file") != "error").select("source_file", "value").write.partitionBy(
        "source_file"
    ).text(f"{source}/gnss")
    results = ingest_directory(spark, source, out, OPTIONS)
    return results.groupBy("file_type").agg(
        F.sum("record_count").alias("records"),
        shown(F.min("time_min")).alias("time_min"),
        shown(F.max("time_max")).alias("time_max"),
    )


@query(
    "ingest_incremental",
    f"""
    WITH lines AS (
        SELECT event_type, event_id, value, event_type = 'view' AND value < 5 AS bad,
               CASE WHEN event_type IN ('click', 'purchase') THEN date_trunc('second', ts) ELSE ts END AS t
        FROM events
    ), kept AS (
        SELECT *, row_number() OVER (PARTITION BY event_type, t ORDER BY event_id) AS n
        FROM lines WHERE NOT bad
    )
    SELECT event_type, count(*) AS records, {shown_sql('min(t)')} AS time_min,
           {shown_sql('max(t)')} AS time_max, round(sum(value), 2) AS total
    FROM kept WHERE n = 1 GROUP BY event_type
    UNION ALL
    SELECT 'bad_time', count(*), NULL, NULL, NULL FROM lines WHERE bad
    """,
)
def ingest_incremental(spark, sf_dir):
    """Two folders into one output on one day, with times in three formats, then the
    first folder again: every row and every reject is there once."""
    root, out = scratch_dir(spark, "folders"), scratch_dir(spark, "out")
    kind = F.col("event_type")
    time = (
        F.when((kind == "view") & (F.col("value") < 5), "sometime")
        .when(kind == "click", F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
        .when(kind == "purchase", F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    lines = table(spark, sf_dir, "events").select(
        "event_type", "event_id", time.alias("time"), F.lit(41.2).alias("latitude"),
        F.lit(1.8).alias("longitude"), F.col("value").alias("TEMP"),
    )
    first = kind.isin("click", "view")
    for name, chosen in (("a", first), ("b", ~first)):
        # One file per type: keep-first is by file.
        lines.where(chosen).repartition("event_type").sortWithinPartitions("event_type", "event_id").drop(
            "event_id"
        ).write.partitionBy("event_type").option("header", True).csv(f"{root}/{name}")
    for name in ("a", "b", "a"):
        ingest_directory(spark, f"{root}/{name}", out, OPTIONS)
    data = current_table(spark, out, "data").groupBy(
        F.regexp_extract("source_file", "event_type=([a-z]*)", 1).alias("event_type")
    ).agg(
        F.count(F.lit(1)).alias("records"),
        shown(F.min("time")).alias("time_min"),
        shown(F.max("time")).alias("time_max"),
        F.round(F.sum("TEMP"), 2).alias("total"),
    )
    rejects = current_table(spark, out, "rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))
    return data.unionByName(rejects.withColumnRenamed("reject_reason", "event_type"), allowMissingColumns=True)


# --- streams --------------------------------------------------------------


def _run(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now into a Parquet sink and read that."""
    spark = stream.sparkSession
    out, state = scratch_dir(spark, name), scratch_dir(spark, f"{name}-state")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", state
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query("stream_files", "SELECT event_type AS source, concat(event_id, ' ', props) AS value FROM events")
def stream_files(spark, sf_dir):
    """Files appear below a directory; every line arrives once."""
    folder = scratch_dir(spark, "watch")
    table(spark, sf_dir, "events").select(
        "event_type", F.concat_ws(" ", F.col("event_id").cast("string"), "props").alias("value")
    ).write.partitionBy("event_type").text(folder)
    source = F.regexp_extract("source_file", "event_type=([a-z]*)", 1)
    return _run(stream_lines(spark, folder, "*.txt", 2), "stream-files").select(
        source.alias("source"), "value"
    )


@query(
    "stream_nmea",
    f"""
    SELECT CASE WHEN pos THEN latitude END AS latitude, CASE WHEN pos THEN longitude END AS longitude,
           CASE WHEN event_type = 'purchase' THEN sats END AS num_satellites,
           CASE WHEN event_type IN ('view', 'click') THEN round(tenths / 10.0 * 0.514444, 6) END
               AS speed_over_ground,
           {shown_sql('ts')} AS time
    FROM (SELECT *, {_POSITION_SQL}, event_type IN ('view', 'purchase') AS pos
          FROM ({NMEA_FIELDS_SQL}))
    WHERE event_type <> 'error' AND NOT (event_type = 'view' AND value < 5)
    """,
)
def stream_nmea(spark, sf_dir):
    """The batch sentence parser on a line stream."""
    folder = scratch_dir(spark, "gnss")
    lines = inputs.sentence_lines(spark, sf_dir).where(F.col("source_file") != "error")
    lines.select("source_file", "value").write.partitionBy("source_file").text(folder)
    return _run(stream_sentences(stream_lines(spark, folder, "*.txt", 2)), "stream-nmea").select(
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
        F.col("num_satellites").cast("bigint").alias("num_satellites"),
        F.round("speed_over_ground", 6).alias("speed_over_ground"),
        shown("time").alias("time"),
    )


@query("stream_downsample", gap_sql() + "SELECT user_id, event_id FROM walk WHERE kept")
def stream_downsample(spark, sf_dir):
    rows = _event_stream(spark, sf_dir).select("user_id", "ts", "event_id")
    return _run(
        stream_min_gap(rows, ["user_id"], "ts", "event_id", GAP_HOURS * 3600), "stream-gap"
    ).select("user_id", "event_id")


@query(
    "stream_changed_readings",
    """
    SELECT user_id, event_id FROM (
        SELECT user_id, event_id, date_trunc('day', ts) AS day,
               lag(date_trunc('day', ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS before
        FROM events) WHERE before IS DISTINCT FROM day
    """,
)
def stream_changed_readings(spark, sf_dir):
    rows = _event_stream(spark, sf_dir).select(
        "user_id", F.date_trunc("day", "ts").alias("day"), "event_id"
    )
    return _run(stream_changed(rows, ["user_id"], "day", "event_id"), "stream-changed").select(
        "user_id", "event_id"
    )


@query(
    "stream_batch_results",
    f"""
    SELECT event_type, {shown_sql("time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01')")}
               AS batch_start, count(*) AS record_count, min(value) AS lat_min, max(value) AS lat_max
    FROM events GROUP BY ALL
    """,
)
def stream_batch_results_query(spark, sf_dir):
    """Windowed results of a stream, rewritten as a whole by each micro-batch."""
    out, state = scratch_dir(spark, "stream-batches"), scratch_dir(spark, "stream-batches-state")
    rows = _event_stream(spark, sf_dir).select(
        "event_type", F.col("ts").cast("timestamp").alias("time"),
        F.col("value").alias("latitude"), F.col("value").alias("longitude"),
    )
    results = stream_batch_results(rows, ["event_type"], seconds=4 * 3600)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    results.writeStream.outputMode("complete").foreachBatch(replace).option(
        "checkpointLocation", state
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select(
        "event_type", shown("batch_start").alias("batch_start"), "record_count", "lat_min", "lat_max"
    )


@query(
    "stream_readings",
    f"""
    SELECT event_type AS site, {shown_sql('max(ts)')} AS time, arg_max(value, ts) AS temperature
    FROM events GROUP BY event_type
    """,
)
def stream_readings_query(spark, sf_dir):
    """One small reading file per site, the newest event of each."""
    folder = scratch_dir(spark, "readings")
    newest = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.max_by(F.struct("ts", "value"), "ts").alias("r")
    )
    newest.select(
        F.date_format("r.ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("Timestamp"),
        F.col("r.value").alias("Temperature"),
        F.col("event_type").alias("Site"),
        F.col("event_type").alias("_site"),
    ).write.partitionBy("_site").option("header", True).csv(folder)
    return _run(stream_readings(spark, folder), "stream-readings").select(
        F.col("extra")["site"].alias("site"), shown("time").alias("time"), "temperature"
    )
