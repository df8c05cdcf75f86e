"""Published manufacturer equations of the frequency CTD sensors.

Coefficients are typed structs, cast once per cast and not once per scan. One
that the calibration file lacks is null and makes the calibrated value null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KELVIN = 273.15
SEA_LEVEL_PSI = 14.7
DBAR_PER_PSI = 0.6894759
DEFAULT_AD590M = 0.01278
DEFAULT_AD590B = -9.256
DEFAULT_T5 = 0.0
DEFAULT_WBOTC = 0.0

# Coefficient names with their defaults, if any.
TEMPERATURE_COEFFICIENTS = {"G": None, "H": None, "I": None, "J": None, "F0": None}
CONDUCTIVITY_COEFFICIENTS = {
    "G": None, "H": None, "I": None, "J": None, "CPcor": None, "CTcor": None,
    "WBOTC": DEFAULT_WBOTC,
}
PRESSURE_COEFFICIENTS = {
    "C1": None, "C2": None, "C3": None, "D1": None, "D2": None,
    "T1": None, "T2": None, "T3": None, "T4": None, "T5": DEFAULT_T5,
    "AD590M": DEFAULT_AD590M, "AD590B": DEFAULT_AD590B,
}


def _series(x: Column, coefficients: list[Column]) -> Column:
    return reduce(lambda acc, c: acc * x + c, reversed(coefficients[:-1]), coefficients[-1])


def coefficients(entries: Column, names: dict[str, float | None]) -> Column:
    """Typed struct of the named entries of a coefficient map."""
    fields = []
    for name, default in names.items():
        value = entries[name].try_cast("double")
        if default is not None:
            value = F.coalesce(value, F.lit(default))
        fields.append(value.alias(name))
    return F.struct(*fields)


def _values(c: Column, names: dict[str, float | None]) -> list[Column]:
    return [c[name] for name in names]


def temperature(freq: Column, c: Column) -> Column:
    """ITS-90 °C from hertz."""
    g, h, i, j, f0 = _values(c, TEMPERATURE_COEFFICIENTS)
    log = F.ln(F.try_divide(f0, freq))
    return F.try_divide(F.lit(1.0), _series(log, [g, h, i, j])) - KELVIN


def pressure(freq: Column, compensation: Column, c: Column) -> Column:
    """Sea pressure in dbar from hertz and the 12-bit compensation count."""
    c1, c2, c3, d1, d2, t1, t2, t3, t4, t5, m, b = _values(c, PRESSURE_COEFFICIENTS)
    u = compensation * m + b
    period = F.try_divide(F.lit(1.0e6), freq)
    ratio = F.try_divide(_series(u, [t1, t2, t3, t4, t5]), period)
    w = F.lit(1.0) - ratio * ratio
    psia = _series(u, [c1, c2, c3]) * w * (F.lit(1.0) - _series(u, [d1, d2]) * w)
    return (psia - SEA_LEVEL_PSI) * DBAR_PER_PSI


def conductivity(freq: Column, temperature: Column, pressure: Column, c: Column) -> Column:
    """S/m from hertz, °C and dbar."""
    g, h, i, j, cpcor, ctcor, wbotc = _values(c, CONDUCTIVITY_COEFFICIENTS)
    khz = freq * F.sqrt(temperature * wbotc + 1.0) / F.lit(1000.0)
    f2 = khz * khz
    siemens = g + f2 * (h + khz * i + f2 * j)
    return F.try_divide(
        siemens, (F.lit(1.0) + ctcor * temperature + cpcor * pressure) * F.lit(10.0)
    )
