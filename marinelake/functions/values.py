"""Trimming, safe casts and value guessing."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHITESPACE = " \t\r\n\x0b\x0c"


def strip(text: Column) -> Column:
    """Trim blanks, tabs and line ends on both sides."""
    return F.btrim(text, F.lit(_WHITESPACE))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(strip(text)) == 0)


def finite(value: Column) -> Column:
    """Null for NaN, which sorts above every number, and for the infinities."""
    return F.when(F.abs(value) <= F.lit(sys.float_info.max), value)


def castable(text: Column) -> Column:
    """Whether a trimmed text starts like a number.

    A failing cast costs many times a good one, so blanks and words never get
    there.
    """
    return F.ascii(text).between(ord("+"), ord("9"))


def number(text: Column) -> Column:
    """Text to a finite DOUBLE; anything else becomes null."""
    trimmed = strip(text)
    return F.when(castable(trimmed), finite(trimmed.try_cast("double")))


def utc_time(text: Column) -> Column:
    """ISO-8601 text to an instant; anything else becomes null."""
    return F.try_to_timestamp(strip(text))


# Fixed formats of table files beside ISO-8601; month before day.
TIME_FORMATS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "yyyy/M/d H:mm:ss",
    "yyyyMMdd'T'HHmmssX",
    "yyyyMMdd'T'HHmmss",
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy H:mm",
    "d-MMM-yyyy H:mm:ss",
)


def table_time(text: Column) -> Column:
    """Text of a table cell to an instant, in ISO-8601 or one of the fixed formats."""
    cell = strip(text)
    return F.coalesce(utc_time(text), *[F.try_to_timestamp(cell, F.lit(f)) for f in TIME_FORMATS])


def guessed_value(text: Column) -> Column:
    """A stream cell as ``struct(kind, num, text)``.

    Integral numbers are ``int``, other finite numbers ``float``, the rest is
    ``string`` and keeps its text.
    """
    num = number(text)
    kind = (
        F.when(num.isNull(), "string").when(num == F.floor(num), "int").otherwise("float")
    )
    return F.struct(
        kind.alias("kind"),
        num.alias("num"),
        F.when(num.isNull(), text).alias("text"),
    )


def signed_degrees(degrees: Column, minutes: Column, hemisphere: Column) -> Column:
    """Degrees and minutes with a hemisphere letter to signed decimal degrees."""
    value = degrees + minutes / F.lit(60.0)
    return (
        F.when(F.upper(hemisphere).isin("S", "W"), -value)
        .when(F.upper(hemisphere).isin("N", "E"), value)
    )


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row.

    The optimizer copies the expression of a projected column into every filter
    and projection that uses it. Generated columns are not copied, which keeps
    the plans of long parsing chains linear. The expressions themselves stay in
    a projection below the generator, where they are compiled.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.withColumn("_packed", packed).select(*kept, F.inline(F.array("_packed")))
