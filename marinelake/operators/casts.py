"""CTD casts: companions, decoding, calibration and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.functions import calibration, seawater
from marinelake.functions.lines import classify_cast_line
from marinelake.functions.names import directory, stem
from marinelake.functions.scans import SCRATCH, decode_scan, scan_groups, scan_offsets
from marinelake.functions.values import computed_once
from marinelake.operators.sequence import moving_average

CAST_KEY = ["dir", "stem_lc"]

# Places in the sensor list from which on a sensor is a secondary one, the
# rate of scans, and the time over which the compensation count is averaged.
SECONDARY_TEMPERATURE_FROM = 3
SECONDARY_CONDUCTIVITY_FROM = 4
SCANS_PER_SECOND = 24
COMPENSATION_SECONDS = 30


def with_cast_key(df: DataFrame, path: str = "source_file", fold_case: bool = True) -> DataFrame:
    """Directory and stem that tie a cast's files together."""
    name = stem(F.col(path))
    return df.withColumns(
        {"dir": directory(F.col(path)), "stem_lc": F.lower(name) if fold_case else name}
    )


def one_companion(companions: DataFrame, path: str = "source_file") -> DataFrame:
    """First companion by name of each cast."""
    rest = [c for c in companions.columns if c not in CAST_KEY]
    return (
        companions.groupBy(*CAST_KEY)
        .agg(F.min_by(F.struct(*rest), path).alias("_one"))
        .select(*CAST_KEY, "_one.*")
    )


def companion_join(scans: DataFrame, headers: DataFrame, calibrations: DataFrame) -> DataFrame:
    """Scans with the header and calibration of their cast, each null when missing.

    All three carry ``dir`` and ``stem_lc``. The companions, one row per cast,
    are brought together first, so that the scans are joined once: by broadcast
    when the measured size allows, otherwise by a sort-merge join whose hot casts
    the adaptive skew join can split.
    """
    header, calibration_ = (one_companion(c).drop("source_file") for c in (headers, calibrations))
    return scans.join(header.join(calibration_, CAST_KEY, "full"), CAST_KEY, "left")


def cast_position(df: DataFrame) -> DataFrame:
    """Header position before scan position; scan time before header time."""
    return df.withColumns(
        {
            "latitude": F.coalesce("hdr_latitude", "scan_latitude"),
            "longitude": F.coalesce("hdr_longitude", "scan_longitude"),
            "time": F.coalesce("scan_time", "start_time"),
        }
    )


def first_sensor(sensors: Column, kind: str, start: int = 0) -> Column:
    """Coefficient map of the first sensor of a type, from a place in the list on."""
    listed = F.slice(sensors, start + 1, F.greatest(F.size(sensors), F.lit(1))) if start else sensors
    return F.get(F.filter(listed, lambda s: s["type"] == kind), F.lit(0))["coefficients"]


def decode_scans(df: DataFrame, scan: str = "hex_scan") -> DataFrame:
    """Raw channels of every scan; the scan text is kept.

    Reads the calibration columns ``frequency_channels_suppressed,
    voltage_words_suppressed, nmea_position_added, scan_time_added``.
    """
    offsets = scan_offsets(
        F.col("frequency_channels_suppressed"),
        F.col("voltage_words_suppressed"),
        F.col("nmea_position_added"),
        F.col("scan_time_added"),
    )
    grouped = df.withColumns(offsets).withColumns(scan_groups(F.col(scan)))
    return computed_once(grouped, decode_scan()).drop(*SCRATCH)


def with_coefficients(calibrations: DataFrame) -> DataFrame:
    """Typed coefficients of the first sensor of each kind, on the one row per cast, and
    of the secondary temperature and conductivity sensors, which come later in the list."""
    sensors = F.col("sensors")

    def typed(kind: str, names: dict[str, float | None], start: int = 0) -> Column:
        return calibration.coefficients(first_sensor(sensors, kind, start), names)

    return calibrations.withColumns(
        {
            "temperature_cal": typed("TemperatureSensor", calibration.TEMPERATURE_COEFFICIENTS),
            "pressure_cal": typed("PressureSensor", calibration.PRESSURE_COEFFICIENTS),
            "conductivity_cal": typed("ConductivitySensor", calibration.CONDUCTIVITY_COEFFICIENTS),
            "temperature2_cal": typed("TemperatureSensor", calibration.TEMPERATURE_COEFFICIENTS, SECONDARY_TEMPERATURE_FROM),
            "conductivity2_cal": typed("ConductivitySensor", calibration.CONDUCTIVITY_COEFFICIENTS, SECONDARY_CONDUCTIVITY_FROM),
        }
    )


def smoothed_compensation(
    scans: DataFrame, keys: list[str], position: str = "scan", seconds: float = COMPENSATION_SECONDS, name: str = "pressure_comp"
) -> DataFrame:
    """Add the compensation count of the pressure sensor averaged over ``seconds`` around
    each scan, at 24 scans a second."""
    half = int(seconds * SCANS_PER_SECOND / 2)
    return moving_average(scans, keys, position, "temperature_comp", half, half, name)


def calibrate(df: DataFrame) -> DataFrame:
    """Temperature, pressure, conductivity, salinity and depth from raw channels, and the
    same of the secondary sensors where the secondary channels are there.

    Reads the columns of :func:`with_coefficients`; whatever lacks a channel or a
    coefficient is null. The pressure takes the smoothed compensation count,
    ``pressure_comp``, where the rows have it. Both conductivities share the pressure.
    """
    p = F.col("pressure")
    latitude = F.coalesce(F.col("hdr_latitude"), F.lit(0.0))
    compensation = F.col("pressure_comp" if "pressure_comp" in df.columns else "temperature_comp")
    done = df.withColumn("pressure", calibration.pressure(F.col("pressure_freq"), compensation, F.col("pressure_cal")))
    chains = [""] + (["2"] if {"temperature2_freq", "conductivity2_freq"} <= set(df.columns) else [])
    for chain in chains:
        t, c = F.col(f"temperature{chain}"), F.col(f"conductivity{chain}")
        done = (
            done.withColumn(
                f"temperature{chain}",
                calibration.temperature(F.col(f"temperature{chain}_freq"), F.col(f"temperature{chain}_cal")),
            )
            .withColumn(
                f"conductivity{chain}",
                calibration.conductivity(F.col(f"conductivity{chain}_freq"), t, p, F.col(f"conductivity{chain}_cal")),
            )
            .withColumn(f"salinity{chain}", seawater.salinity(c, t, p))
        )
    scratch = [f"{name}_cal" for name in ("temperature", "pressure", "conductivity", "temperature2", "conductivity2")]
    return done.withColumn("depth", seawater.depth(p, latitude)).drop(*scratch, "pressure_comp")


def preamble_roles(lines: DataFrame, key: str = "source_file", order: str = "line_ord") -> DataFrame:
    """Role of every line of a scan stream with preamble, by its place in the stream.

    Lines between the XMLCON marks are ``xmlcon``; star lines after ``*END*``
    are ``ignore``. The marks of a stream are one aggregated row.
    """
    role = F.col("_role")
    marked = lines.withColumn("_role", classify_cast_line(F.col("value")))
    marks = marked.groupBy(key).agg(
        *[
            F.min(F.when(role == mark, F.col(order))).alias(f"_{mark}")
            for mark in ("xmlcon_start", "xmlcon_end", "header_end")
        ]
    )
    at = F.col(order)
    in_xmlcon = (at > F.col("_xmlcon_start")) & (
        F.col("_xmlcon_end").isNull() | (at < F.col("_xmlcon_end"))
    )
    commented = role.isin("header", "comment", "header_end")
    resolved = (
        F.when(commented & in_xmlcon, "xmlcon")
        .when(role.isin("xmlcon_start", "xmlcon_end", "header_end", "scan"), role)
        .when(commented & (F.col("_header_end").isNull() | (at < F.col("_header_end"))), "header")
        .otherwise("ignore")
    )
    return (
        marked.join(marks, key)
        .withColumn("role", resolved)
        .drop("_role", "_xmlcon_start", "_xmlcon_end", "_header_end")
    )
