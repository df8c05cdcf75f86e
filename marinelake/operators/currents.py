"""ADCP ensembles and the choice between echo sounder and velocity rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.options import (
    CORRELATION_THRESHOLD,
    ENSEMBLE_SECONDS,
    TRANSDUCER_DEPTH_M,
)

# Beam angle of a common four-beam instrument, in degrees.
BEAM_ANGLE = 20.0
BEAMS = 4


def _mean_of_beams(beams: str, cell: Column) -> Column:
    return sum((F.col(beams)[b][cell] for b in range(1, BEAMS)), F.col(beams)[0][cell]) / BEAMS


def explode_cells(pings: DataFrame) -> DataFrame:
    """One row per ping and depth cell, with the four beams as an array."""
    cells = pings.select("*", F.posexplode("range").alias("cell", "_range"))
    at = F.col("cell")
    return cells.select(
        "source_file",
        "time",
        "heading",
        "pitch",
        "roll",
        F.col("temp").alias("temperature"),
        "cell",
        F.col("_range").alias("range"),
        F.array(*[F.col("vel")[b][at] for b in range(BEAMS)]).alias("beams"),
        _mean_of_beams("corr", at).alias("corr"),
        _mean_of_beams("amp", at).alias("amp"),
    )


def beam_to_earth(cells: DataFrame, beam_angle: float = BEAM_ANGLE) -> DataFrame:
    """East, north and up velocities from four beams and the ship's attitude.

    The convex Janus transform to instrument axes, then roll, pitch and heading.
    """
    import math

    a = 1.0 / (2.0 * math.sin(math.radians(beam_angle)))
    b = 1.0 / (4.0 * math.cos(math.radians(beam_angle)))
    b1, b2, b3, b4 = (F.col("beams")[i] for i in range(BEAMS))
    x, y, z = (b1 - b2) * a, (b4 - b3) * a, (b1 + b2 + b3 + b4) * b
    head, pitch, roll = (F.radians(F.col(c)) for c in ("heading", "pitch", "roll"))
    ch, sh = F.cos(head), F.sin(head)
    cp, sp = F.cos(pitch), F.sin(pitch)
    cr, sr = F.cos(roll), F.sin(roll)
    return cells.withColumns({"_x": x, "_y": y, "_z": z}).select(
        *[c for c in cells.columns if c != "beams"],
        (
            F.col("_x") * (ch * cr + sh * sp * sr)
            + F.col("_y") * sh * cp
            + F.col("_z") * (ch * sr - sh * sp * cr)
        ).alias("u"),
        (
            F.col("_y") * ch * cp
            - F.col("_x") * (sh * cr - ch * sp * sr)
            - F.col("_z") * (sh * sr + ch * sp * cr)
        ).alias("v"),
        (F.col("_y") * sp - F.col("_x") * cp * sr + F.col("_z") * cp * cr).alias("w"),
    )


def ensembles(
    cells: DataFrame,
    seconds: int = ENSEMBLE_SECONDS,
    threshold: float = CORRELATION_THRESHOLD,
    transducer_depth: float = TRANSDUCER_DEPTH_M,
) -> DataFrame:
    """Average of the cells over fixed time bins; low-correlation velocities are left out.

    Needs ``u, v, w, amp, corr, heading, temperature, range, cell``. The heading
    is the direction of the mean unit vector. There is one row per ping and cell,
    so the pings of a bin are counted without a distinct.
    """
    good = F.col("corr") >= threshold
    angle = F.radians("heading")
    return (
        cells.groupBy(
            "source_file",
            F.window("time", f"{seconds} seconds").getField("start").alias("time"),
            "cell",
        )
        .agg(
            (F.min("range") + transducer_depth).alias("depth"),
            *[F.avg(F.when(good, F.col(c))).alias(c) for c in ("u", "v", "w")],
            F.avg("amp").alias("amp"),
            F.avg(F.sin(angle)).alias("_sin"),
            F.avg(F.cos(angle)).alias("_cos"),
            F.avg("temperature").alias("temperature"),
            F.count(F.lit(1)).alias("num_pings"),
        )
        .withColumn(
            "heading",
            F.pmod(F.degrees(F.atan2("_sin", "_cos")), F.lit(360.0)),
        )
        .select(
            "source_file", "time", "cell", "depth", "u", "v", "w",
            "amp", "heading", "temperature", "num_pings",
        )
    )


def adcp_ensembles(pings: DataFrame, **options: float) -> DataFrame:
    """Ping table to ensemble grid rows."""
    return ensembles(beam_to_earth(explode_cells(pings)), **options)


def echo_or_velocity(
    echoes: DataFrame, velocities: DataFrame, source: str = "source_file"
) -> DataFrame:
    """Echo sounder rows of the files that have some, velocity rows of the others."""
    sounding = echoes.select(source).distinct()
    return echoes.unionByName(
        velocities.join(sounding, source, "left_anti"), allowMissingColumns=True
    )
