"""File-added events and latest-reading files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.functions.lines import split_quoted_cells
from marinelake.functions.values import computed_once, number, utc_time
from marinelake.schemas import FILE_EVENT

# Fixed values.
FILE_ADDED = "fileadd"
READING_SOURCE = "ctd_latest"
READING_TYPE = "ctd_csv"
READING_MEASURES = ["temperature", "salinity", "pressure"]


def file_events(messages: DataFrame, value: str = "value", known: DataFrame | None = None) -> DataFrame:
    """Status of each event message: ``queued``, ``skipped`` or ``error``.

    Both path keys are accepted. With ``known`` (a file listing with ``path``) a
    path that is not listed is an error.
    """
    event = F.from_json(value, FILE_EVENT)
    parsed = computed_once(messages, {"_event": event}).select(
        *messages.columns,
        F.col("_event.event").alias("event"),
        F.nullif(
            F.coalesce("_event.file_added_path", "_event.path"), F.lit("")
        ).alias("file"),
        F.col("_event.size").alias("size"),
    )
    found = F.col("file").isNotNull()
    if known is not None:
        listed = known.select(F.col("path").alias("file")).distinct().withColumn("_listed", F.lit(True))
        parsed = parsed.join(listed, "file", "left")
        found = found & F.col("_listed").isNotNull()
    added = F.col("event").eqNullSafe(FILE_ADDED)
    status = F.when(~added, "skipped").when(~found, "error").otherwise("queued")
    reason = F.when(
        ~added, F.concat(F.lit("event="), F.coalesce("event", F.lit("None")))
    ).when(~found, F.concat(F.lit("file not found: "), F.coalesce("file", F.lit(""))))
    return parsed.withColumns({"status": status, "reason": reason}).drop("_listed")


def reading_record(headers: Column, line: Column) -> Column:
    """First data row of a reading file as a map, keys in lower case."""
    names = F.transform(headers, lambda h: F.lower(h))
    cells = split_quoted_cells(line)
    n = F.least(F.size(names), F.size(cells))
    return F.map_from_arrays(F.slice(names, F.lit(1), n), F.slice(cells, F.lit(1), n))


def latest_reading(lines: DataFrame) -> DataFrame:
    """The reading of each file: its first row under its header.

    Two smallest lines per file; readings without a time are dropped.
    """
    usable = lines.where(F.length(F.trim("value")) > 0)
    header = usable.groupBy("source_file").agg(
        F.min("line_ord").alias("header_ord"), F.min_by("value", "line_ord").alias("header")
    )
    body = usable.join(header, "source_file").where(F.col("line_ord") > F.col("header_ord"))
    first = body.groupBy("source_file").agg(
        F.min_by(F.struct("header", "value"), "line_ord").alias("_first")
    )
    return typed_reading(
        first.select(
            "source_file",
            reading_record(
                split_quoted_cells(F.col("_first.header")), F.col("_first.value")
            ).alias("record"),
        )
    )


def typed_reading(readings: DataFrame) -> DataFrame:
    """Typed columns of a ``record`` map; ``timestamp`` counts as ``time``."""
    record = F.col("record")
    stamp = F.coalesce(record["timestamp"], record["time"])
    rest = F.map_filter(record, lambda k, _: ~k.isin(["timestamp", "time", *READING_MEASURES]))
    timed = computed_once(readings, {"time": utc_time(stamp)})
    return timed.where(F.col("time").isNotNull()).select(
        *[c for c in readings.columns if c != "record"],
        "time",
        *[number(record[c]).alias(c) for c in READING_MEASURES],
        rest.alias("extra"),
        F.lit(READING_SOURCE).alias("source"),
        F.lit(READING_TYPE).alias("file_type"),
    )
