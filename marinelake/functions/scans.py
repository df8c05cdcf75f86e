"""Decoding of fixed-width hexadecimal CTD scans.

A scan is laid out left to right as: frequency words (3 bytes each), voltage
words (3 bytes, two 12-bit voltages each), position (7 bytes, when added),
pressure-temperature compensation with status and modulo (3 bytes), system time
(4 bytes, when added). Suppressed words shift everything after them, so every
offset is a column expression over the calibration row of the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scan format.
FREQUENCY_WORDS = 5
VOLTAGE_WORDS = 4
WORD_CHARS = 6
POSITION_CHARS = 14
TIME_CHARS = 8
POSITION_SCALE = 50000.0
VOLTAGE_FULL_SCALE = 5.0
VOLTAGE_STEPS = 4095
SOUTH_BIT = 0x80
WEST_BIT = 0x40

FREQUENCY_CHANNELS = [
    "temperature_freq",
    "conductivity_freq",
    "pressure_freq",
    "temperature2_freq",
    "conductivity2_freq",
]
VOLTAGE_CHANNELS = [f"volt{i}" for i in range(2 * VOLTAGE_WORDS)]


def scan_offsets(
    frequencies_suppressed: Column,
    voltages_suppressed: Column,
    position_added: Column,
    time_added: Column,
) -> dict[str, Column]:
    """Where each part of the scans of a cast starts, in hex digits.

    Null flags count as nothing suppressed and nothing added.
    """
    n_freq = F.lit(FREQUENCY_WORDS) - F.coalesce(frequencies_suppressed, F.lit(0))
    n_volt = F.lit(VOLTAGE_WORDS) - F.coalesce(voltages_suppressed, F.lit(0))
    has_position = F.coalesce(position_added, F.lit(False))
    volts_at = n_freq * WORD_CHARS
    position_at = volts_at + n_volt * WORD_CHARS
    status_at = position_at + F.when(has_position, POSITION_CHARS).otherwise(0)
    return {
        "_volts_at": volts_at,
        "_position_at": position_at,
        "_status_at": status_at,
        "_time_at": F.when(F.coalesce(time_added, F.lit(False)), status_at + WORD_CHARS),
    }


# Groups of neighbouring fields, each read as one integer: start and width in digits.
_GROUPS = {
    "_freq_a": (None, 0, 2 * WORD_CHARS),
    "_freq_b": (None, 2 * WORD_CHARS, 2 * WORD_CHARS),
    "_freq_c": (None, 4 * WORD_CHARS, WORD_CHARS),
    "_volt_a": ("_volts_at", 0, 2 * WORD_CHARS),
    "_volt_b": ("_volts_at", 2 * WORD_CHARS, 2 * WORD_CHARS),
    "_place": ("_position_at", 0, POSITION_CHARS),
    "_state": ("_status_at", 0, WORD_CHARS),
    "_clock": ("_time_at", 0, TIME_CHARS),
}
SCRATCH = ["_volts_at", "_position_at", "_status_at", "_time_at", "_length", *_GROUPS]


def _start(base: str | None, offset: int) -> Column:
    return F.lit(offset) if base is None else F.col(base) + offset


def scan_groups(scan: Column) -> dict[str, Column]:
    """The field groups of a scan; a group cut short is filled up with zeros."""
    groups = {"_length": F.length(scan)}
    for name, (base, offset, width) in _GROUPS.items():
        digits = F.substr(scan, _start(base, offset) + 1, F.lit(width))
        groups[name] = F.conv(F.rpad(digits, width, "0"), 16, 10).try_cast("bigint")
    return groups


def _field(group: str, at: int, width: int) -> Column:
    """``width`` digits of a group from digit ``at``; null past the end of the scan."""
    base, offset, total = _GROUPS[group]
    bits = F.shiftright(F.col(group), 4 * (total - at - width))
    present = _start(base, offset) + at + width <= F.col("_length")
    return F.when(present, bits.bitwiseAND((1 << (4 * width)) - 1))


def decode_scan() -> dict[str, Column]:
    """Named raw channels from the field groups; a channel the cast lacks is null."""
    volts_at, position_at = F.col("_volts_at"), F.col("_position_at")
    channels: dict[str, Column] = {}
    for word, name in enumerate(FREQUENCY_CHANNELS):
        raw = _field("_freq_" + "abc"[word // 2], word % 2 * WORD_CHARS, WORD_CHARS)
        # Three bytes of hertz, the last one a fraction.
        channels[name] = F.when(F.lit(word * WORD_CHARS) < volts_at, raw / F.lit(256.0))
    for i, name in enumerate(VOLTAGE_CHANNELS):
        steps = _field("_volt_" + "ab"[i // 4], i % 4 * 3, 3)
        volts = (F.lit(1.0) - steps / F.lit(float(VOLTAGE_STEPS))) * VOLTAGE_FULL_SCALE
        channels[name] = F.when(volts_at + 3 * i < position_at, volts)

    located = position_at < F.col("_status_at")
    sign = _field("_place", 2 * WORD_CHARS, 2)
    for name, at, bit in (("scan_latitude", 0, SOUTH_BIT), ("scan_longitude", WORD_CHARS, WEST_BIT)):
        size = _field("_place", at, WORD_CHARS) / F.lit(POSITION_SCALE)
        hemisphere = F.when(sign.bitwiseAND(bit) != 0, -1.0).when(sign.isNotNull(), 1.0)
        channels[name] = F.when(located, size * hemisphere)
    channels["temperature_comp"] = _field("_state", 0, 3)
    channels["status"] = _field("_state", 3, 1).cast("int")
    channels["modulo"] = _field("_state", 4, 2).cast("int")
    # Four bytes, lowest first.
    seconds = sum(_field("_clock", 2 * byte, 2) * 256**byte for byte in range(4))
    channels["scan_time"] = F.timestamp_seconds(seconds)
    return channels
