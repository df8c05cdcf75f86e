"""GNSS sentences: envelope, checksum and the four sentence types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.functions.lines import is_sentence
from marinelake.functions.values import (
    castable,
    computed_once,
    finite,
    signed_degrees,
    strip,
    utc_time,
)

# Fixed values.
SENTENCE_TYPES = ["GGA", "RMC", "VTG", "ZDA"]
KNOT_IN_METRES_PER_SECOND = 0.514444

# The positions that hold numbers, by sentence type.
_NUMERIC_FIELDS = {
    1: ["VTG"],
    2: ["GGA", "ZDA"],
    3: ["RMC", "ZDA"],
    4: ["GGA", "ZDA"],
    5: ["RMC", "VTG"],
    6: ["GGA"],
    7: ["GGA", "RMC"],
    8: ["GGA", "RMC"],
    9: ["GGA"],
}

_OUTPUTS = [
    "time",
    "latitude",
    "longitude",
    "gps_quality",
    "num_satellites",
    "horizontal_dilution",
    "gps_antenna_height",
    "speed_over_ground",
    "course_over_ground",
    "gps_utc_time",
]


def checksum(body: Column) -> Column:
    """XOR of the characters between ``$`` and ``*``, as two hex digits."""
    xor = F.aggregate(
        F.split(body, ""), F.lit(0), lambda acc, char: acc.bitwiseXOR(F.ascii(char))
    )
    return F.lpad(F.hex(xor), 2, "0")


def _field(position: int) -> Column:
    """Field of the sentence, null when missing or blank."""
    text = F.get(F.col("_fields"), position)
    return F.when(F.length(text) > 0, text)


def _number(position: int) -> Column:
    """Finite number of a field, from the casts made by :func:`with_envelope`."""
    return finite(F.col(f"_n{position}"))


def _angle(position: int) -> Column:
    """A ``dddmm.mmmm`` field and the hemisphere letter after it."""
    packed = F.col(f"_n{position}")
    degrees = F.floor(packed / 100)
    return finite(signed_degrees(degrees, packed - degrees * 100, _field(position + 1)))


def _whole(position: int) -> Column:
    return F.col(f"_n{position}").try_cast("int")


def _clock_seconds(position: int) -> Column:
    return F.substring(_field(position), 5, 20).try_cast("decimal(8,6)")


def with_envelope(df: DataFrame, line: str) -> DataFrame:
    """Split a line into time prefix, body, fields and the checksum sent."""
    text = strip(F.col(line))
    sentence_at = F.instr(text, "$")
    sentence = F.when(is_sentence(F.col(line)), F.substr(text, sentence_at))
    body = F.substring_index(F.substr(F.col("_sentence"), F.lit(2)), "*", 1)
    sent_checksum = F.regexp_extract("_sentence", r"\*\s*([0-9A-Fa-f]{1,2})\s*$", 1)
    return (
        df.withColumns(
            {
                "_prefix": F.when(sentence_at > 1, F.substr(text, F.lit(1), sentence_at - 1)),
                "_sentence": sentence,
            }
        )
        .withColumns({"_body": body, "_sent": sent_checksum})
        .withColumn("_fields", F.split("_body", ","))
        .withColumn("_kind", F.substring(F.get("_fields", F.lit(0)), 3, 3))
        .withColumns(
            {f"_n{i}": _cast_field(i, kinds) for i, kinds in _NUMERIC_FIELDS.items()}
        )
    )


def _cast_field(position: int, kinds: list[str]) -> Column:
    text = strip(F.get(F.col("_fields"), F.lit(position)))
    wanted = F.col("_kind").isin(kinds) & castable(text)
    return F.when(wanted, text.try_cast("double"))


def _sentence_time(received: str) -> Column:
    """Time of the prefix; a bare sentence takes it from the ``received`` column."""
    bare = F.col("_prefix").isNull()
    time = F.when(bare, F.col(received).cast("timestamp")).otherwise(utc_time(F.col("_prefix")))
    return F.when(F.col("_sentence").isNotNull(), time)


def _checksum_ok() -> Column:
    """An absent checksum is accepted; null when the line is no sentence."""
    same = checksum(F.col("_body")) == F.lpad(F.upper("_sent"), 2, "0")
    return F.when(F.col("_sentence").isNotNull(), (F.col("_sent") == "") | same)


def parse_sentences(df: DataFrame, line: str = "value", received: str = "ingest_ts") -> DataFrame:
    """Add the GNSS columns, ``sentence_type`` and ``reject_reason`` to each line.

    A bare sentence takes its time from ``received``, so that a rerun gives the
    same result. ``reject_reason`` is null on the rows the record path keeps.
    """
    kind = F.col("_kind")
    gga, rmc, vtg, zda = (kind == name for name in SENTENCE_TYPES)
    active = rmc & (F.upper(_field(2)) == "A")
    columns = {
        "time": _sentence_time(received),
        "checksum_ok": _checksum_ok(),
        "sentence_type": kind,
        "latitude": F.when(gga, _angle(2)).when(active, _angle(3)),
        "longitude": F.when(gga, _angle(4)).when(active, _angle(5)),
        "gps_quality": F.when(gga, _whole(6)),
        "num_satellites": F.when(gga, _whole(7)),
        "horizontal_dilution": F.when(gga, _number(8)),
        "gps_antenna_height": F.when(gga, _number(9)),
        "speed_over_ground": F.when(active, _number(7)).when(vtg, _number(5))
        * KNOT_IN_METRES_PER_SECOND,
        "course_over_ground": F.when(active, _number(8)).when(vtg, _number(1)),
        "gps_utc_time": F.when(
            zda,
            F.try_make_timestamp(
                _whole(4),
                _whole(3),
                _whole(2),
                F.substring(_field(1), 1, 2).try_cast("int"),
                F.substring(_field(1), 3, 2).try_cast("int"),
                _clock_seconds(1),
            ),
        ),
    }
    parsed = computed_once(with_envelope(df, line), columns)
    empty = reduce(
        lambda a, b: a & b, [F.col(name).isNull() for name in _OUTPUTS if name != "time"]
    )
    reason = (
        F.when(F.length(strip(F.col(line))) == 0, "blank")
        .when(F.col("checksum_ok").isNull(), "not_a_sentence")
        .when(~F.col("checksum_ok"), "bad_checksum")
        .when(F.col("sentence_type").isNull(), "unsupported_sentence")
        .when(~F.col("sentence_type").isin(SENTENCE_TYPES), "unsupported_sentence")
        .when(F.col("time").isNull(), "bad_time")
        .when(empty, "no_fields")
    )
    return parsed.withColumn("reject_reason", reason).drop(
        "_prefix", "_sentence", "_body", "_sent", "_fields", "_kind",
        *[f"_n{i}" for i in _NUMERIC_FIELDS],
    )


def gnss_columns() -> list[str]:
    return list(_OUTPUTS)
