"""Queries of the CTD casts and ADCP ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marinelake.functions import calibration, seawater
from marinelake.operators.casts import (
    COMPENSATION_SECONDS,
    SCANS_PER_SECOND,
    calibrate,
    decode_scans,
    first_sensor,
    with_coefficients,
)
from marinelake.operators.currents import adcp_ensembles, echo_or_velocity
from marinelake.operators.sequence import moving_average, scan_number
from marinelake.plans import inputs
from marinelake.plans.inputs import SCAN_FIELDS_SQL
from marinelake.plans.registry import bigint, query, shown, shown_sql, table
from marinelake.sources.casts import parse_calibration, parse_header

# Coefficients of one invented instrument.
TEMPERATURE = {"G": 4.34e-3, "H": 6.4e-4, "I": 2.3e-5, "J": 2.0e-6, "F0": 1000.0}
PRESSURE = {
    "C1": -42000.0, "C2": -0.5, "C3": 0.014, "D1": 0.038, "D2": 0.0,
    "T1": 30.3, "T2": -3.0e-4, "T3": 4.0e-6, "T4": 3.0e-9,
}
CONDUCTIVITY = {
    "G": -10.0, "H": 1.4, "I": -2.0e-3, "J": 2.4e-4, "CPcor": -9.57e-8, "CTcor": 3.25e-6,
}


def _map(values: dict[str, float]):
    return F.create_map(*[F.lit(x) for n, v in values.items() for x in (n, repr(v))])


def _typed(values: dict[str, float], names: dict[str, float | None]):
    return calibration.coefficients(_map(values), names)


def _scans(spark, sf_dir):
    return decode_scans(inputs.hex_scans(spark, sf_dir))


def _volt(digits: str) -> str:
    return f"round((1 - {digits} / 4095.0::DOUBLE) * 5.0::DOUBLE, 6)"


@query(
    "ctd_scan_decode",
    f"""
    SELECT l_orderkey, l_linenumber, f0 / 256.0::DOUBLE AS temperature_freq,
           f1 / 256.0::DOUBLE AS conductivity_freq, f2 / 256.0::DOUBLE AS pressure_freq,
           CASE WHEN l_returnflag <> 'R' THEN f3 / 256.0::DOUBLE END AS temperature2_freq,
           CASE WHEN l_returnflag <> 'R' THEN f4 / 256.0::DOUBLE END AS conductivity2_freq,
           {_volt('v0')} AS volt0, {_volt('v2')} AS volt5,
           CASE WHEN l_returnflag <> 'N' THEN {_volt('v1')} END AS volt7,
           CASE WHEN l_returnflag <> 'N' THEN lat / 50000.0::DOUBLE
                * CASE WHEN sign & 128 > 0 THEN -1 ELSE 1 END END AS scan_latitude,
           CASE WHEN l_returnflag <> 'N' THEN lon / 50000.0::DOUBLE
                * CASE WHEN sign & 64 > 0 THEN -1 ELSE 1 END END AS scan_longitude,
           comp AS temperature_comp, status, modulo,
           CASE WHEN l_returnflag <> 'R' THEN strftime(to_timestamp(seconds) AT TIME ZONE 'UTC',
                '%Y-%m-%d %H:%M:%S') END AS scan_time
    FROM (SELECT * REPLACE (CAST(status AS BIGINT) AS status) FROM ({SCAN_FIELDS_SQL}))
    """,
)
def ctd_scan_decode(spark, sf_dir):
    """Three scan layouts in one pass, offsets from the calibration flags of each row."""
    return _scans(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "temperature_freq", "conductivity_freq", "pressure_freq",
        "temperature2_freq", "conductivity2_freq",
        *[F.round(f"volt{i}", 6).alias(f"volt{i}") for i in (0, 5, 7)],
        "scan_latitude", "scan_longitude", "temperature_comp",
        bigint(F.col("status")).alias("status"), bigint(F.col("modulo")).alias("modulo"),
        F.date_format("scan_time", "yyyy-MM-dd HH:mm:ss").alias("scan_time"),
    )


# Raw channels in plausible ranges, from line items.
_FREQ = {
    "t_freq": "3000 + l_partkey % 3000 + l_discount",
    "c_freq": "2800 + l_suppkey * 3 + l_tax",
    "p_freq": "33100 + l_partkey % 3000 + l_quantity / 64",
    "comp": "2000 + l_suppkey % 600",
}

_CHANNELS_SQL = (
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _FREQ.items())
    + " FROM lineitem"
)


def _channels(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        *[F.expr(e).cast("double").alias(n) for n, e in _FREQ.items()],
    )


def _temperature_sql(freq: str = "t_freq", values: dict[str, float] = TEMPERATURE) -> str:
    g, h, i, j, f0 = values.values()
    log = f"ln({f0}::DOUBLE / {freq})"
    return (
        f"1 / ({g}::DOUBLE + {log} * ({h}::DOUBLE + {log} * ({i}::DOUBLE + {log} * {j}::DOUBLE)))"
        " - 273.15::DOUBLE"
    )


def _pressure_sql() -> str:
    p = {k: f"{v}::DOUBLE" for k, v in PRESSURE.items()}
    u = "(0.01278::DOUBLE * comp - 9.256::DOUBLE)"
    c = f"({p['C1']} + {u} * ({p['C2']} + {u} * {p['C3']}))"
    d = f"({p['D1']} + {u} * {p['D2']})"
    t0 = f"({p['T1']} + {u} * ({p['T2']} + {u} * ({p['T3']} + {u} * {p['T4']})))"
    w = f"(1 - ({t0} * p_freq / 1.0e6::DOUBLE) * ({t0} * p_freq / 1.0e6::DOUBLE))"
    return f"({c} * {w} * (1 - {d} * {w}) - 14.7::DOUBLE) * 0.6894759::DOUBLE"


def _conductivity_sql(t: str, p: str, freq: str = "c_freq") -> str:
    g, h, i, j, cpcor, ctcor = (f"{v}::DOUBLE" for v in CONDUCTIVITY.values())
    f = f"({freq} / 1000)"
    return (
        f"({g} + {h} * {f} ** 2 + {i} * {f} ** 3 + {j} * {f} ** 4)"
        f" / (10 * (1 + {ctcor} * {t} + {cpcor} * {p}))"
    )


def _salinity_sql(c: str, t90: str, p: str) -> str:
    r, t = f"({c} * 10 / 42.914::DOUBLE)", f"({t90} * 1.00024::DOUBLE)"
    rp = (
        f"(1 + {p} * (2.070e-5 - 6.370e-10 * {p} + 3.989e-15 * {p} * {p}) / (1 + 3.426e-2 * {t}"
        f" + 4.464e-4 * {t} * {t} + (4.215e-1 - 3.107e-3 * {t}) * {r}))"
    )
    rt = (
        f"(0.6766097 + 2.00564e-2 * {t} + 1.104259e-4 * {t} ** 2 - 6.9698e-7 * {t} ** 3"
        f" + 1.0031e-9 * {t} ** 4)"
    )
    root = f"sqrt({r} / ({rp} * {rt}))"
    a = " + ".join(f"({v}) * {root} ** {i}" for i, v in enumerate(seawater.SALINITY_A))
    b = " + ".join(f"({v}) * {root} ** {i}" for i, v in enumerate(seawater.SALINITY_B))
    bend = f"(({t} - 15) / (1 + 0.0162::DOUBLE * ({t} - 15)))"
    whole = f"({a} + {bend} * ({b}))"
    x, y = f"(400 * {root} ** 2)", f"(10 * {root})"
    return (
        f"CASE WHEN {whole} >= 2 THEN {whole} ELSE {whole} - 0.008::DOUBLE / (1 + 1.5::DOUBLE * {x} + {x} ** 2)"
        f" - 0.0005::DOUBLE * {bend} / (1 + {y} + {y} ** 2 + {y} ** 3) END"
    )


def _depth_sql(p: str, latitude: str) -> str:
    x = f"(sin(radians({latitude})) ** 2)"
    gravity = f"(9.780318::DOUBLE * (1 + (5.2788e-3 + 2.36e-5 * {x}) * {x}) + 1.092e-6 * {p})"
    return (
        f"((((-1.82e-15 * {p} + 2.279e-10) * {p} - 2.2512e-5) * {p} + 9.72659::DOUBLE) * {p})"
        f" / {gravity}"
    )


@query(
    "ctd_temperature",
    f"""SELECT l_orderkey, l_linenumber, round({_temperature_sql()}, 6) AS temperature,
               NULL::DOUBLE AS without_coefficient FROM ({_CHANNELS_SQL})""",
)
def ctd_temperature(spark, sf_dir):
    """A missing coefficient gives null and leaves the rest alone."""
    partial = {k: v for k, v in TEMPERATURE.items() if k != "J"}
    freq = F.col("t_freq")
    return _channels(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.round(calibration.temperature(freq, _typed(TEMPERATURE, calibration.TEMPERATURE_COEFFICIENTS)), 6).alias("temperature"),
        calibration.temperature(freq, _typed(partial, calibration.TEMPERATURE_COEFFICIENTS)).alias("without_coefficient"),
    )


@query(
    "ctd_pressure",
    f"""SELECT l_orderkey, l_linenumber, round({_pressure_sql()}, 5) AS pressure
        FROM ({_CHANNELS_SQL})""",
)
def ctd_pressure(spark, sf_dir):
    pressure = calibration.pressure(F.col("p_freq"), F.col("comp"), _typed(PRESSURE, calibration.PRESSURE_COEFFICIENTS))
    return _channels(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.round(pressure, 5).alias("pressure")
    )


@query(
    "ctd_conductivity",
    f"""SELECT l_orderkey, l_linenumber,
               round({_conductivity_sql('(t_freq / 300)', '(p_freq / 10)')}, 6) AS conductivity
        FROM ({_CHANNELS_SQL})""",
)
def ctd_conductivity(spark, sf_dir):
    conductivity = calibration.conductivity(
        F.col("c_freq"), F.col("t_freq") / 300, F.col("p_freq") / 10, _typed(CONDUCTIVITY, calibration.CONDUCTIVITY_COEFFICIENTS)
    )
    return _channels(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.round(conductivity, 6).alias("conductivity")
    )


@query(
    "ctd_salinity",
    f"""SELECT l_orderkey, l_linenumber,
               round({_salinity_sql('(2 + l_discount * 20)', '(l_quantity * 0.6)', '(l_suppkey * 1.0::DOUBLE)')}, 6)
               AS salinity FROM lineitem""",
)
def ctd_salinity(spark, sf_dir):
    salinity = seawater.salinity(
        F.col("l_discount") * 20 + 2, F.col("l_quantity") * 0.6, F.col("l_suppkey").cast("double")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(salinity, 6).alias("salinity")
    )


@query(
    "ctd_depth",
    f"""SELECT l_orderkey, l_linenumber,
               round({_depth_sql('(l_partkey * 1.0::DOUBLE)', '(l_suppkey % 90)')}, 5) AS depth
        FROM lineitem""",
)
def ctd_depth(spark, sf_dir):
    depth = seawater.depth(F.col("l_partkey").cast("double"), F.col("l_suppkey") % 90)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(depth, 5).alias("depth")
    )


@query(
    "ctd_calibrated",
    f"""
    WITH tp AS (SELECT *, {_temperature_sql()} AS t, {_pressure_sql()} AS p
                FROM ({_CHANNELS_SQL})),
    tpc AS (SELECT *, {_conductivity_sql('t', 'p')} AS c FROM tp)
    SELECT l_orderkey, l_linenumber, round(t, 5) AS temperature, round(p, 4) AS pressure,
           round(c, 5) AS conductivity, round({_salinity_sql('c', 't', 'p')}, 4) AS salinity,
           round({_depth_sql('p', '30')}, 4) AS depth
    FROM tpc
    """,
)
def ctd_calibrated(spark, sf_dir):
    """Raw channels and the calibration of their cast to all calibrated columns."""
    def sensor(kind, values):
        return F.struct(F.lit(kind).alias("type"), _map(values).alias("coefficients"))

    sensors = F.array(
        sensor("TemperatureSensor", TEMPERATURE),
        sensor("ConductivitySensor", CONDUCTIVITY),
        sensor("PressureSensor", PRESSURE),
        sensor("TemperatureSensor", {"G": 1.0}),
    )
    raw = _channels(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        F.col("t_freq").alias("temperature_freq"),
        F.col("c_freq").alias("conductivity_freq"),
        F.col("p_freq").alias("pressure_freq"),
        F.col("comp").alias("temperature_comp"),
        F.lit(30.0).alias("hdr_latitude"),
        (F.col("l_suppkey") % 25).cast("int").alias("cast"),
    )
    casts = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("cast"), sensors.alias("sensors")
    )
    places = {"temperature": 5, "pressure": 4, "conductivity": 5, "salinity": 4, "depth": 4}
    joined = raw.join(with_coefficients(casts), "cast", "left")
    return calibrate(joined).select(
        "l_orderkey", "l_linenumber", *[F.round(c, n).alias(c) for c, n in places.items()]
    )


@query(
    "ctd_fresh_water",
    f"""SELECT l_orderkey, l_linenumber,
               round({_salinity_sql('((l_partkey % 70) / 100.0::DOUBLE)', '(l_quantity * 0.6)', '((l_suppkey % 40) * 1.0::DOUBLE)')}, 6)
               AS salinity FROM lineitem""",
)
def ctd_fresh_water(spark, sf_dir):
    """Salinities from 0 to about 6, on both sides of the low-salinity extension."""
    salinity = seawater.salinity(
        (F.col("l_partkey") % 70) / 100, F.col("l_quantity") * 0.6, (F.col("l_suppkey") % 40).cast("double")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(salinity, 6).alias("salinity")
    )


SECONDARY = {"G": 4.1e-3, "H": 6.2e-4, "I": 2.1e-5, "J": 1.9e-6, "F0": 1000.0}


@query(
    "secondary_sensors",
    f"""
    WITH raw AS (SELECT *, t_freq + 50 AS t2_freq, c_freq + 20 AS c2_freq, l_orderkey % 3 AS cast_no FROM ({_CHANNELS_SQL})),
    tp AS (SELECT *, {_pressure_sql()} AS p, {_temperature_sql()} AS t,
                  CASE WHEN cast_no < 2 THEN {_temperature_sql('t2_freq', SECONDARY)} END AS t2 FROM raw),
    tpc AS (SELECT *, CASE WHEN cast_no = 0 THEN {_conductivity_sql('t2', 'p', 'c2_freq')} END AS c2 FROM tp)
    SELECT l_orderkey, l_linenumber, round(t, 5) AS temperature, round(t2, 5) AS temperature2,
           round(c2, 5) AS conductivity2, round({_salinity_sql('c2', 't2', 'p')}, 4) AS salinity2
    FROM tpc
    """,
)
def secondary_sensors(spark, sf_dir):
    """Casts with two secondary sensors, with one, and with none."""
    def sensor(kind, values):
        return F.struct(F.lit(kind).alias("type"), _map(values).alias("coefficients"))

    other = sensor("NotInUse", {"G": 0.0})
    first = [sensor("TemperatureSensor", TEMPERATURE), sensor("ConductivitySensor", CONDUCTIVITY), sensor("PressureSensor", PRESSURE)]
    second = [sensor("TemperatureSensor", SECONDARY), sensor("ConductivitySensor", CONDUCTIVITY)]
    lists = [F.array(*first, *second), F.array(*first, second[0], other), F.array(*first)]
    number = F.col("n_nationkey")
    casts = table(spark, sf_dir, "nation").where(number < 3).select(
        number.cast("bigint").alias("cast_no"), F.when(number == 0, lists[0]).when(number == 1, lists[1]).otherwise(lists[2]).alias("sensors")
    )
    raw = _channels(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.col("t_freq").alias("temperature_freq"), F.col("c_freq").alias("conductivity_freq"),
        F.col("p_freq").alias("pressure_freq"), F.col("comp").alias("temperature_comp"),
        (F.col("t_freq") + 50).alias("temperature2_freq"), (F.col("c_freq") + 20).alias("conductivity2_freq"),
        F.lit(30.0).alias("hdr_latitude"), (F.col("l_orderkey") % 3).alias("cast_no"),
    )
    places = {"temperature": 5, "temperature2": 5, "conductivity2": 5, "salinity2": 4}
    return calibrate(raw.join(with_coefficients(casts), "cast_no", "left")).select(
        "l_orderkey", "l_linenumber", *[F.round(c, n).alias(c) for c, n in places.items()]
    )


@query(
    "pressure_compensation",
    """
    SELECT event_id, event_type AS source_file, round(avg((event_id * 7919) % 4096) OVER (
               PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 360 PRECEDING AND 360 FOLLOWING), 9) AS pressure_comp
    FROM events
    """,
)
def pressure_compensation(spark, sf_dir):
    """The compensation count averaged over 30 s, in blocks of 1000 scans."""
    scans = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_file"), "event_id", (F.col("event_id") * 7919 % 4096).alias("temperature_comp")
    )
    half = COMPENSATION_SECONDS * SCANS_PER_SECOND // 2
    numbered = scan_number(scans, "event_id")
    found = moving_average(numbered, ["source_file"], "scan", "temperature_comp", half, half, "pressure_comp", block=1000)
    return found.select("event_id", "source_file", F.round("pressure_comp", 9).alias("pressure_comp"))


@query(
    "cast_header",
    f"""
    SELECT c_custkey,
           round(CASE WHEN c_acctbal < 0 THEN -1 ELSE 1 END * (c_custkey % 90
                 + (c_custkey % 60 + (c_custkey % 100) / 100.0) / 60), 6) AS latitude,
           round(CASE WHEN c_nationkey < 12 THEN -1 ELSE 1 END * (c_custkey % 180
                 + (c_custkey % 59 + (c_custkey % 100) / 100.0) / 60), 6) AS longitude,
           {shown_sql("TIMESTAMP '1970-01-01' + to_seconds(c_custkey * 86399)")} AS start_time,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS station,
           c_custkey % 50 + 20 AS bytes_per_scan, (c_nationkey % 5)::BIGINT AS voltage_words
    FROM customer
    """,
)
def cast_header(spark, sf_dir):
    return parse_header(inputs.header_documents(spark, sf_dir)).select(
        "c_custkey",
        F.round("hdr_latitude", 6).alias("latitude"),
        F.round("hdr_longitude", 6).alias("longitude"),
        shown("start_time").alias("start_time"),
        "station",
        bigint(F.col("bytes_per_scan")).alias("bytes_per_scan"),
        bigint(F.col("voltage_words")).alias("voltage_words"),
    )


@query(
    "cast_calibration",
    """
    SELECT s_suppkey, (CASE WHEN ok THEN s_nationkey % 3 ELSE 0 END)::BIGINT
               AS frequency_channels_suppressed,
           (CASE WHEN ok THEN s_nationkey % 4 ELSE 0 END)::BIGINT AS voltage_words_suppressed,
           ok AND s_nationkey % 2 = 1 AS nmea_position_added, ok AS scan_time_added,
           (CASE WHEN ok THEN 4 ELSE 0 END)::BIGINT AS sensors,
           CASE WHEN ok THEN s_suppkey + 0.5::DOUBLE END AS temperature_g,
           CASE WHEN ok THEN s_nationkey + 0.25::DOUBLE END AS conductivity_g,
           CASE WHEN ok THEN s_suppkey * 2.0::DOUBLE END AS pressure_c1,
           ok AND s_nationkey < 12 AS secondary_temperature
    FROM (SELECT *, s_acctbal >= 0 AS ok FROM supplier)
    """,
)
def cast_calibration(spark, sf_dir):
    """Flags and coefficients, equation 1 preferred; malformed XML gives defaults."""
    parsed = parse_calibration(inputs.calibration_documents(spark, sf_dir))
    sensors = F.col("sensors")

    def value(kind, name):
        return first_sensor(sensors, kind)[name].try_cast("double")

    return parsed.select(
        "s_suppkey",
        bigint(F.col("frequency_channels_suppressed")).alias("frequency_channels_suppressed"),
        bigint(F.col("voltage_words_suppressed")).alias("voltage_words_suppressed"),
        "nmea_position_added",
        "scan_time_added",
        bigint(F.size(sensors)).alias("sensors"),
        value("TemperatureSensor", "G").alias("temperature_g"),
        value("ConductivitySensor", "G").alias("conductivity_g"),
        value("PressureSensor", "C1").alias("pressure_c1"),
        "secondary_temperature",
    )


def _rotated() -> str:
    """Beam to earth in SQL, angles in radians."""
    return """
        SELECT *, x * (cos(h) * cos(r) + sin(h) * sin(p) * sin(r)) + y * sin(h) * cos(p)
                  + z * (cos(h) * sin(r) - sin(h) * sin(p) * cos(r)) AS u,
               y * cos(h) * cos(p) - x * (sin(h) * cos(r) - cos(h) * sin(p) * sin(r))
                  - z * (sin(h) * sin(r) + cos(h) * sin(p) * cos(r)) AS v,
               y * sin(p) - x * cos(p) * sin(r) + z * cos(p) * cos(r) AS w
        FROM (SELECT *, (b1 - b2) / (2 * sin(radians(20))) AS x,
                     (b4 - b3) / (2 * sin(radians(20))) AS y,
                     (b1 + b2 + b3 + b4) / (4 * cos(radians(20))) AS z FROM beams)
    """


@query(
    "adcp_ensemble",
    f"""
    WITH cells AS (SELECT vec_id, label, embedding, unnest(range(16)) AS cell FROM embeddings),
    beams AS (
        SELECT concat('adcp_', label, '.raw') AS source_file, cell,
               TIMESTAMP '2024-01-01' + to_seconds(vec_id * 10) AS ts,
               embedding[cell + 1]::DOUBLE AS b1, embedding[cell + 17]::DOUBLE AS b2,
               embedding[cell + 33]::DOUBLE AS b3, embedding[cell + 49]::DOUBLE AS b4,
               radians(10.0 + (vec_id * 7) % 160) AS h, radians((vec_id % 11) / 10.0) AS p,
               radians((vec_id % 7) / 10.0) AS r, 5.0 + (vec_id % 100) / 10.0 AS temp
        FROM cells),
    earth AS ({_rotated()}),
    flagged AS (SELECT *, (abs(b1) + abs(b2) + abs(b3) + abs(b4)) / 4 AS mean FROM earth)
    SELECT source_file, {shown_sql("time_bucket(INTERVAL 120 SECOND, ts, TIMESTAMP '1970-01-01')")}
               AS time, cell::BIGINT AS cell, cell * 8.0::DOUBLE + 4 + 7 AS depth,
           round(avg(u) FILTER (mean * 600 >= 64), 6) AS u,
           round(avg(v) FILTER (mean * 600 >= 64), 6) AS v,
           round(avg(w) FILTER (mean * 600 >= 64), 6) AS w,
           round(avg(mean) * 100, 6) AS amp,
           round(degrees(atan2(avg(sin(h)), avg(cos(h)))), 6) AS heading,
           round(avg(temp), 6)::DOUBLE AS temperature, count(*) AS num_pings
    FROM flagged GROUP BY ALL
    """,
)
def adcp_ensemble(spark, sf_dir):
    grid = adcp_ensembles(inputs.pings(spark, sf_dir))
    return grid.select(
        "source_file", shown("time").alias("time"), bigint(F.col("cell")).alias("cell"), "depth",
        *[F.round(c, 6).alias(c) for c in ("u", "v", "w", "amp", "heading", "temperature")],
        "num_pings",
    )


@query(
    "echo_or_velocity",
    """
    SELECT vec_id, concat('file_', label) AS source_file,
           CASE WHEN label < 4 THEN embedding[1]::DOUBLE END AS sv,
           CASE WHEN label >= 4 THEN embedding[2]::DOUBLE END AS u
    FROM embeddings
    """,
)
def echo_or_velocity_query(spark, sf_dir):
    """Files that have echo rows give those, the others their velocity rows."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "source_file", F.concat(F.lit("file_"), F.col("label"))
    )
    first, second = (F.col("embedding")[i].cast("double") for i in (0, 1))
    echoes = vectors.where(F.col("label") < 4).select("vec_id", "source_file", first.alias("sv"))
    velocities = vectors.select("vec_id", "source_file", second.alias("u"))
    return echo_or_velocity(echoes, velocities)
