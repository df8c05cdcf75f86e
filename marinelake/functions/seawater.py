"""Practical salinity and depth after UNESCO technical paper 44 (1983), below 2 with the
extension to low salinities of Hill, Dauphinee and Woods (1986)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published coefficients.
C_35_15_0 = 42.914  # mS/cm
T68_PER_T90 = 1.00024
SALINITY_A = [0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081]
SALINITY_B = [0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144]
SALINITY_K = 0.0162
FRESH_BELOW = 2.0
RT_C = [0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9]
RP_E = [0.0, 2.070e-5, -6.370e-10, 3.989e-15]
RP_D1, RP_D2, RP_D3, RP_D4 = 3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3
DEPTH_C = [0.0, 9.72659, -2.2512e-5, 2.279e-10, -1.82e-15]
GRAVITY_EQUATOR = 9.780318
GRAVITY_SIN2, GRAVITY_SIN4 = 5.2788e-3, 2.36e-5
GRAVITY_PRESSURE = 1.092e-6


def polynomial(x: Column, coefficients: list[float]) -> Column:
    """``c0 + c1 x + c2 x² + …`` by nesting."""
    return reduce(
        lambda acc, c: acc * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1])
    )


def salinity_from_ratio(ratio: Column, t68: Column, pressure: Column) -> Column:
    """Salinity from conductivity ratio, IPTS-68 temperature and dbar."""
    rp = F.lit(1.0) + polynomial(pressure, RP_E) / (
        F.lit(1.0) + t68 * RP_D1 + t68 * t68 * RP_D2 + (t68 * RP_D4 + RP_D3) * ratio
    )
    rt = F.try_divide(ratio, rp * polynomial(t68, RT_C))
    root = F.when(rt >= 0, F.sqrt(rt))
    warm = t68 - 15.0
    bend = F.try_divide(warm, warm * SALINITY_K + F.lit(1.0))
    practical = polynomial(root, SALINITY_A) + bend * polynomial(root, SALINITY_B)
    # The extension: x is 400 times the ratio, y its root times 10.
    x, y = rt * 400.0, root * 10.0
    fresh = practical - F.lit(SALINITY_A[0]) / polynomial(x, [1.0, 1.5, 1.0]) - F.lit(SALINITY_B[0]) * bend / polynomial(y, [1.0, 1.0, 1.0, 1.0])
    return F.when(practical < FRESH_BELOW, fresh).otherwise(practical)


def salinity(conductivity: Column, temperature: Column, pressure: Column) -> Column:
    """Practical salinity from S/m, ITS-90 °C and dbar."""
    ratio = conductivity * F.lit(10.0) / F.lit(C_35_15_0)
    return salinity_from_ratio(ratio, temperature * T68_PER_T90, pressure)


def depth(pressure: Column, latitude: Column) -> Column:
    """Depth in metres from dbar and latitude in degrees."""
    sine = F.sin(F.radians(latitude))
    x = sine * sine
    gravity = (
        (x * GRAVITY_SIN4 + GRAVITY_SIN2) * x + 1.0
    ) * GRAVITY_EQUATOR + pressure * GRAVITY_PRESSURE
    return polynomial(pressure, DEPTH_C) / gravity
