"""Line classification and delimited-line parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marinelake.functions.values import strip

# Talker prefixes of the sentences the engine reads, and the
# shortest run of hex digits that counts as a scan.
TALKER_PREFIXES = ["$GP", "$GN", "$GL", "$GA", "$GB", "$GI"]
MIN_SCAN_CHARS = 40

_TALKERS = "|".join(prefix[1:] for prefix in TALKER_PREFIXES)
# Possessive, so that a long line without a blank is read once.
_SENTENCE = rf"^\s*+(?:\S++\s++)?\$(?:{_TALKERS})"
_SCAN = rf"^\s*[0-9A-Fa-f]{{{MIN_SCAN_CHARS},}}\s*$"
_COMMENT = r"^\s*[*#]"


def is_scan(line: Column) -> Column:
    return line.rlike(_SCAN)


def is_sentence(line: Column) -> Column:
    """A sentence from a known talker, bare or after a time token."""
    return ~line.rlike(_COMMENT) & line.rlike(_SENTENCE)


def detect_format(line: Column) -> Column:
    """``nmea``, ``hex`` or ``csv`` for one line."""
    return (
        F.when(line.rlike(_COMMENT), "csv")
        .when(line.rlike(_SENTENCE), "nmea")
        .when(is_scan(line), "hex")
        .otherwise("csv")
    )


def classify_cast_line(line: Column) -> Column:
    """Role of a line in a hex scan stream that carries its own preamble."""
    text = strip(line)
    return (
        F.when(text == "# XMLCON_START", "xmlcon_start")
        .when(text == "# XMLCON_END", "xmlcon_end")
        .when(text == "*END*", "header_end")
        .when(text.startswith("*"), "header")
        .when(text.startswith("#"), "comment")
        .when(is_scan(text), "scan")
        .otherwise("ignore")
    )


def split_cells(line: Column) -> Column:
    """Comma-separated cells, trimmed, without quoting."""
    return F.transform(F.split(line, ","), strip)


def split_quoted_cells(line: Column) -> Column:
    """Comma-separated cells of a file line, where quotes may hide commas."""
    outside_quotes = r'\s*,\s*(?=(?:[^"]*"[^"]*")*[^"]*$)'
    return F.when(
        F.contains(line, F.lit('"')),
        F.transform(
            F.split(strip(line), outside_quotes),
            lambda cell: F.replace(
                F.regexp_replace(cell, r'^"|"$', ""), F.lit('""'), F.lit('"')
            ),
        ),
    ).otherwise(split_cells(line))


def csv_record(line: Column, headers: Column) -> Column:
    """Map of header to non-blank cell, null when the cell count differs.

    A line without any non-blank cell gives an empty map.
    """
    cells = split_cells(line)
    record = F.map_filter(
        F.map_from_arrays(headers, cells), lambda _, cell: F.length(cell) > 0
    )
    return F.when(F.size(cells) == F.size(headers), record)
