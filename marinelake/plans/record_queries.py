"""Queries over timed records: de-duplication, statistics, sequences and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from marinelake.operators import enrich, metadata, quality, sequence, throttle
from marinelake.operators.casts import cast_position, companion_join, with_cast_key
from marinelake.options import ProviderRule
from marinelake.plans import inputs
from marinelake.plans.inputs import DAY_FILE_SQL, OBSERVATIONS_SQL
from marinelake.plans.registry import query, shown, shown_sql, table

OBS = f"WITH obs AS ({OBSERVATIONS_SQL})"


def _hourly(spark, sf_dir):
    """Observations of each source on a clock of whole hours, so that times collide."""
    obs = inputs.observations(spark, sf_dir)
    return obs.withColumn("time", F.date_trunc("hour", "time"))


_HOURLY_SQL = f"""
    WITH obs AS (SELECT * REPLACE (date_trunc('hour', time) AS time) FROM ({OBSERVATIONS_SQL})),
    firsts AS (SELECT * FROM obs
        QUALIFY row_number() OVER (PARTITION BY source_file, time ORDER BY line_ord) = 1)
"""


@query(
    "dedupe_first",
    f"""{_HOURLY_SQL}
    SELECT source_file, {shown_sql('time')} AS time, line_ord, device, depth, "TEMP" FROM firsts
    """,
)
def dedupe_first(spark, sf_dir):
    rows = _hourly(spark, sf_dir).select(
        "source_file", "time", "line_ord", "device", "depth", "TEMP"
    )
    kept = quality.dedupe_first(rows, ["source_file", "time"])
    return kept.withColumn("time", shown("time"))


@query(
    "dedupe_merge",
    f"""{_HOURLY_SQL}
    SELECT source_file, {shown_sql('time')} AS time,
           arg_min(line_ord, line_ord) AS line_ord,
           arg_min(latitude, line_ord) FILTER (latitude IS NOT NULL) AS latitude,
           arg_min("CNDC", line_ord) FILTER ("CNDC" IS NOT NULL) AS "CNDC"
    FROM obs GROUP BY ALL
    """,
)
def dedupe_merge(spark, sf_dir):
    """Every column takes its first non-null value at a time."""
    rows = _hourly(spark, sf_dir).select("source_file", "time", "line_ord", "latitude", "CNDC")
    merged = quality.dedupe_first(rows, ["source_file", "time"], merge=True)
    return merged.withColumn("time", shown("time"))


@query(
    "file_metadata",
    f"""{_HOURLY_SQL}
    SELECT source_file, count(*) AS record_count,
           CASE WHEN count(*) FILTER (ok) > 0 THEN count(*) FILTER (ok) ELSE count(*) END
               AS written_count,
           concat_ws(',', 'device', 'event_type', CASE WHEN count(latitude) > 0 THEN 'latitude' END,
               CASE WHEN count(longitude) > 0 THEN 'longitude' END,
               CASE WHEN count(depth) > 0 THEN 'depth' END,
               CASE WHEN count("TEMP") > 0 THEN 'TEMP' END,
               CASE WHEN count("PSAL") > 0 THEN 'PSAL' END,
               CASE WHEN count("CNDC") > 0 THEN 'CNDC' END,
               CASE WHEN count(speed_over_ground) > 0 THEN 'speed_over_ground' END, 'time')
               AS columns,
           {shown_sql('min(time)')} AS time_start, {shown_sql('max(time)')} AS time_end,
           min(latitude) FILTER (ok) AS lat_min, max(latitude) FILTER (ok) AS lat_max,
           min(longitude) FILTER (ok) AS lon_min, max(longitude) FILTER (ok) AS lon_max
    FROM (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS ok FROM firsts)
    GROUP BY source_file
    """,
)
def file_metadata(spark, sf_dir):
    """Keep-first per source and hour, then the metadata of each source."""
    kept = quality.dedupe_first(_hourly(spark, sf_dir), ["source_file", "time"])
    return metadata.file_metadata(kept).withColumns(
        {
            "columns": F.concat_ws(",", "columns"),
            "time_start": shown("time_start"),
            "time_end": shown("time_end"),
        }
    )


_STATS = ["TEMP", "PSAL", "CNDC", "depth", "speed_over_ground"]


@query(
    "sensor_stats",
    f"""{OBS}
    SELECT source_file, sensor, min(v) AS min, max(v) AS max, round(avg(v), 6) AS mean
    FROM (SELECT source_file, unnest({_STATS}) AS sensor,
                 unnest([{', '.join(f'"{c}"' for c in _STATS)}]) AS v FROM obs)
    WHERE v IS NOT NULL GROUP BY source_file, sensor
    """,
)
def sensor_stats(spark, sf_dir):
    stats = metadata.sensor_stats_long(inputs.observations(spark, sf_dir))
    return stats.withColumn("mean", F.round("mean", 6))


_RESULTS_SQL = f"""
    WITH files AS (SELECT DISTINCT {DAY_FILE_SQL} AS source_file FROM events),
    recs AS (SELECT *, {DAY_FILE_SQL} AS source_file FROM events WHERE event_type <> 'error'
             AND NOT (event_type = 'view' AND ts < TIMESTAMP '2024-01-10')),
    errors AS (SELECT DISTINCT {DAY_FILE_SQL} AS source_file, 'bad header' AS error FROM events
               WHERE event_type = 'signup' AND value > 200),
    results AS (
        SELECT source_file, any_value(error) AS error, count(event_id) AS record_count,
               min(ts) AS time_min, max(ts) AS time_max,
               CASE WHEN any_value(error) IS NOT NULL THEN 'error'
                    WHEN count(event_id) = 0 THEN 'skipped' ELSE 'ok' END AS status
        FROM files LEFT JOIN recs USING (source_file) LEFT JOIN errors USING (source_file)
        GROUP BY source_file)
"""


def _results(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("source_file", inputs.day_file())
    manifest = events.select("source_file").distinct()
    early_view = (F.col("event_type") == "view") & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    records = events.where((F.col("event_type") != "error") & ~early_view).select(
        "source_file",
        F.col("ts").cast("timestamp").alias("time"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )
    errors = events.where((F.col("event_type") == "signup") & (F.col("value") > 200)).select(
        "source_file", F.lit("bad header").alias("error")
    )
    return metadata.file_results(manifest, records, errors)


@query(
    "file_results",
    f"""{_RESULTS_SQL}
    SELECT source_file, status, CASE WHEN status = 'skipped' THEN 'no records parsed' END AS reason,
           error, record_count, {shown_sql('time_min')} AS time_min,
           {shown_sql('time_max')} AS time_max
    FROM results
    """,
)
def file_results(spark, sf_dir):
    return _results(spark, sf_dir).select(
        "source_file", "status", "reason", "error", "record_count",
        shown("time_min").alias("time_min"), shown("time_max").alias("time_max"),
    )


@query(
    "run_summary",
    f"""{_RESULTS_SQL}
    SELECT count(*) AS files, count(*) FILTER (status = 'ok') AS ok,
           count(*) FILTER (status = 'skipped') AS skipped,
           count(*) FILTER (status = 'error') AS errors,
           CAST(sum(record_count) FILTER (status = 'ok') AS BIGINT) AS total_records
    FROM results
    """,
)
def run_summary(spark, sf_dir):
    return metadata.run_summary(_results(spark, sf_dir))


@query(
    "valid_positions",
    f"""{OBS}
    SELECT source_file, line_ord, latitude, longitude FROM (
        SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS ok,
               bool_or(latitude IS NOT NULL AND longitude IS NOT NULL)
                   OVER (PARTITION BY source_file) AS any_ok
        FROM obs) WHERE ok OR NOT any_ok
    """,
)
def valid_positions(spark, sf_dir):
    rows = inputs.observations(spark, sf_dir).select(
        "source_file", "line_ord", "latitude", "longitude"
    )
    return quality.valid_positions(rows)


@query(
    "union_members",
    f"""
    SELECT event_id AS line_ord, CASE WHEN event_type <> 'error' THEN value END AS "TEMP",
           CASE WHEN event_type = 'view' THEN user_id END AS sats,
           CASE WHEN event_type = 'error' THEN props END AS note
    FROM events WHERE event_type IN ('click', 'view', 'error')
    """,
)
def union_members(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_id", "line_ord")
    kind = F.col("event_type")
    value = F.col("value").alias("TEMP")
    return quality.concat_members(
        [
            events.where(kind == "click").select("line_ord", value),
            events.where(kind == "view").select(value, F.col("user_id").alias("sats"), "line_ord"),
            events.where(kind == "error").select("line_ord", F.col("props").alias("note")),
        ]
    )


@query(
    "sorted_track",
    f"""{OBS} SELECT source_file, {shown_sql('time')} AS time, line_ord, device FROM obs""",
)
def sorted_track(spark, sf_dir):
    rows = inputs.observations(spark, sf_dir).select("source_file", "time", "line_ord", "device")
    return quality.sorted_track(rows).withColumn("time", shown("time"))


# --- sequences ------------------------------------------------------------


@query(
    "changed_readings",
    """
    SELECT user_id, event_id, strftime(day, '%Y-%m-%d') AS day FROM (
        SELECT user_id, event_id, date_trunc('day', ts) AS day,
               lag(date_trunc('day', ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS before
        FROM events) WHERE before IS DISTINCT FROM day
    """,
)
def changed_readings(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.to_date("ts").alias("day")
    )
    kept = sequence.changed_readings(rows, ["user_id"], "event_id", "day")
    return kept.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


GAP_HOURS = 6


def gap_sql(force: str = "false") -> str:
    """The greedy rule as a recursive query, one step per record of a device."""
    return f"""
    WITH RECURSIVE numbered AS (
        SELECT user_id, event_id, ts, {force} AS forced,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    walk AS (
        SELECT user_id, event_id, n, ts AS last, true AS kept FROM numbered WHERE n = 1
        UNION ALL
        SELECT r.user_id, r.event_id, r.n,
               CASE WHEN r.forced OR r.ts - w.last >= INTERVAL {GAP_HOURS} HOUR THEN r.ts
                    ELSE w.last END,
               r.forced OR r.ts - w.last >= INTERVAL {GAP_HOURS} HOUR
        FROM walk w JOIN numbered r ON r.user_id = w.user_id AND r.n = w.n + 1)
    """


def _gap_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id")


@query("downsample_min_gap", gap_sql() + "SELECT user_id, event_id FROM walk WHERE kept")
def downsample_min_gap(spark, sf_dir):
    kept = throttle.downsample_min_gap(
        _gap_rows(spark, sf_dir), ["user_id"], "ts", "event_id", GAP_HOURS * 3600
    )
    return kept.select("user_id", "event_id")


_FORCE_SQL = "event_type = 'error' AND value > 150"


@query("downsample_force", gap_sql(_FORCE_SQL) + "SELECT user_id, event_id FROM walk WHERE kept")
def downsample_force(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.expr(_FORCE_SQL).alias("forced")
    )
    kept = throttle.downsample_min_gap(
        rows, ["user_id"], "ts", "event_id", GAP_HOURS * 3600, force="forced"
    )
    return kept.select("user_id", "event_id")


@query(
    "throttle_stats",
    gap_sql()
    + """SELECT user_id, count(*) FILTER (kept) AS records_sent,
                count(*) FILTER (NOT kept) AS records_suppressed FROM walk GROUP BY user_id""",
)
def throttle_stats(spark, sf_dir):
    rows = _gap_rows(spark, sf_dir)
    kept = throttle.kept_records(rows, ["user_id"], "ts", "event_id", GAP_HOURS * 3600)
    return throttle.throttle_stats(rows, kept, ["user_id"])


@query(
    "downsample_bucket",
    """
    SELECT user_id, strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'),
                             '%Y-%m-%d %H:%M:%S') AS bucket_start,
           arg_min(event_id, struct_pack(ts, event_id)) AS event_id
    FROM events GROUP BY ALL
    """,
)
def downsample_bucket(spark, sf_dir):
    rows = _gap_rows(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    first = sequence.downsample_bucket(rows, ["user_id"], "event_id", "ts", GAP_HOURS * 3600)
    return first.select(
        "user_id",
        F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"),
        "event_id",
    )


BATCH = {"seconds": 4 * 3600, "max_records": 7}

_BATCHES_SQL = f"""
    WITH batches AS (
        SELECT *, (row_number() OVER (PARTITION BY event_type, batch_start ORDER BY event_id) - 1)
                  // {BATCH['max_records']} AS batch_part
        FROM (SELECT *, time_bucket(INTERVAL {BATCH['seconds']} SECOND, ts, TIMESTAMP '1970-01-01')
              AS batch_start FROM events))
"""


def _batched(spark, sf_dir):
    rows = inputs.observations(spark, sf_dir).select(
        "event_type", "line_ord", "time", "latitude", "longitude"
    )
    return sequence.assign_batches(rows, ["event_type"], **BATCH)


@query(
    "assign_batches",
    f"""{_BATCHES_SQL} SELECT event_id AS line_ord, {shown_sql('batch_start')} AS batch_start,
        batch_part FROM batches""",
)
def assign_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select(
        "line_ord", shown("batch_start").alias("batch_start"), "batch_part"
    )


@query(
    "batch_results",
    f"""{_BATCHES_SQL}, {OBS[5:]}
    SELECT event_type, {shown_sql('batch_start')} AS batch_start, batch_part,
           count(*) AS record_count, {shown_sql('min(time)')} AS time_min,
           {shown_sql('max(time)')} AS time_max, min(latitude) AS lat_min, max(latitude) AS lat_max,
           min(longitude) AS lon_min, max(longitude) AS lon_max
    FROM batches JOIN (SELECT line_ord AS event_id, time, latitude, longitude FROM obs)
         USING (event_id) GROUP BY event_type, batches.batch_start, batch_part
    """,
)
def batch_results(spark, sf_dir):
    results = metadata.batch_results(
        _batched(spark, sf_dir), ["event_type", "batch_start", "batch_part"]
    )
    return results.withColumns(
        {c: shown(c) for c in ("batch_start", "time_min", "time_max")}
    )


@query(
    "scan_number",
    """
    SELECT o_orderkey, o_orderpriority AS source_file,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS scan
    FROM orders
    """,
)
def scan_number(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("source_file")
    )
    return sequence.scan_number(rows, "o_orderkey")


# --- joins ----------------------------------------------------------------


@query(
    "companion_join",
    """
    SELECT o_orderkey, c.c_name AS station, x.c_nationkey AS serial
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c.c_custkey
    LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') x
         ON o_custkey = x.c_custkey
    """,
)
def companion_join_query(spark, sf_dir):
    """Scans named ``Cast7.hex`` find ``CAST7.HDR`` and ``cast7.XMLCON``; some casts lack one."""
    customer = table(spark, sf_dir, "customer")

    def named(df, pattern, key):
        return with_cast_key(df.withColumn("source_file", F.format_string(pattern, F.col(key))))

    scans = named(table(spark, sf_dir, "orders"), "/ship/Cast%d.hex", "o_custkey")
    headers = named(customer.where(F.col("c_acctbal") > 0), "/ship/CAST%d.HDR", "c_custkey")
    calibrations = named(
        customer.where(F.col("c_mktsegment") != "MACHINERY"), "/ship/cast%d.XMLCON", "c_custkey"
    )
    key = ["source_file", "dir", "stem_lc"]
    return companion_join(
        scans.select("o_orderkey", *key),
        headers.select(*key, F.col("c_name").alias("station")),
        calibrations.select(*key, F.col("c_nationkey").alias("serial")),
    ).select("o_orderkey", "station", "serial")


@query(
    "cast_position",
    f"""
    SELECT o_orderkey, CASE WHEN c_acctbal > 0 THEN c_acctbal / 1000 ELSE o_totalprice / 10000 END
               AS latitude,
           CASE WHEN c_acctbal > 0 THEN c_acctbal / 500 ELSE NULL END AS longitude,
           {shown_sql("CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE TIMESTAMP '2022-06-16' END")}
               AS time
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def cast_position_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 1000).alias("hdr_latitude"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 500).alias("hdr_longitude"),
    )
    scans = table(spark, sf_dir, "orders").join(customer, "o_custkey", "left").select(
        "o_orderkey",
        "hdr_latitude",
        "hdr_longitude",
        (F.col("o_totalprice") / 10000).alias("scan_latitude"),
        F.lit(None).cast("double").alias("scan_longitude"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("timestamp")).alias(
            "scan_time"
        ),
        F.lit("2022-06-16").cast("timestamp").alias("start_time"),
    )
    return cast_position(scans).select(
        "o_orderkey", "latitude", "longitude", shown("time").alias("time")
    )


PROVIDER_RULES = [
    ProviderRule("NATION_3", "(?i)/furn"),
    ProviderRule("NATION_7", "MACHINERY/.*9\\.csv$"),
    ProviderRule("NATION_1", "/MACHINERY/"),
    ProviderRule("NATION_99", "/BUILDING/"),
]


@query(
    "enrich_provider",
    """
    SELECT c_custkey, provider, coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END,
           n_nationkey * 1.5) AS latitude, n_regionkey * 20.0::DOUBLE AS longitude
    FROM (SELECT *, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'NATION_3'
              WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 10 = 9 THEN 'NATION_7'
              WHEN c_mktsegment = 'MACHINERY' THEN 'NATION_1'
              WHEN c_mktsegment = 'BUILDING' THEN 'NATION_99' END AS provider FROM customer)
    LEFT JOIN nation ON provider = n_name
    """,
)
def enrich_provider(spark, sf_dir):
    """Provider by path pattern, its coordinates where none were measured."""
    providers = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("provider"),
        (F.col("n_nationkey") * 1.5).alias("latitude"),
        (F.col("n_regionkey") * 20.0).alias("longitude"),
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.format_string("/in/%s/%d.csv", F.col("c_mktsegment"), F.col("c_custkey")).alias(
            "source_file"
        ),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("latitude"),
    )
    return enrich.enrich_provider(rows, providers, rules=PROVIDER_RULES).select(
        "c_custkey", "provider", "latitude", "longitude"
    )


@query(
    "enrich_observatory",
    """
    SELECT c_custkey, n_name AS site, n_nationkey * 2.0::DOUBLE AS latitude, c_acctbal AS depth,
           c_acctbal * 2 AS temperature
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
)
def enrich_observatory(spark, sf_dir):
    """Fixed coordinates and a column map by observatory key."""
    observatories = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("observatory"),
        F.col("n_name").alias("site"),
        (F.col("n_nationkey") * 2.0).alias("latitude"),
        F.create_map(F.lit("Tryk"), F.lit("depth")).alias("column_map"),
    )
    readings = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("observatory"),
        F.create_map(
            F.lit("Tryk"), F.col("c_acctbal"), F.lit("temperature"), F.col("c_acctbal") * 2
        ).alias("record"),
    )
    enriched = enrich.enrich_observatory(readings, observatories)
    return enriched.select(
        "c_custkey",
        "site",
        "latitude",
        F.col("record")["depth"].alias("depth"),
        F.col("record")["temperature"].alias("temperature"),
    )
