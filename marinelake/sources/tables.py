"""CSV files with a header each, and CNV profiles.

Both join every data line to the header of its own file. The headers are one row
per file and block of its lines, so that the lines of a large file meet theirs in many
tasks; the join is left to the optimizer, which broadcasts the headers when their
measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.functions.lines import csv_record, split_quoted_cells
from marinelake.functions.values import computed_once, number, strip, table_time
from marinelake.schemas import CSV_MEASURES


#: Lines of one block are numbered alike but for these low bits of ``line_ord``.
BLOCK_BITS = 16


def _block() -> Column:
    return F.coalesce(F.shiftright(F.col("line_ord").cast("bigint"), BLOCK_BITS), F.lit(-1))


def _with_headers(data: DataFrame, headers: DataFrame) -> DataFrame:
    """Data lines with the header of their file; ``headers`` name the ``blocks`` of its lines."""
    per_block = headers.withColumn("_block", F.explode("blocks")).drop("blocks")
    return data.withColumn("_block", _block()).join(per_block, ["source_file", "_block"]).drop("_block")


def csv_headers(lines: DataFrame) -> DataFrame:
    """First line of each file that is neither blank nor a comment, and the blocks of all."""
    usable = lines.where(~F.col("value").startswith("#") & (F.length(strip(F.col("value"))) > 0))
    return usable.groupBy("source_file").agg(
        F.min("line_ord").alias("header_ord"),
        F.min_by("value", "line_ord").alias("header"),
        F.collect_set(_block()).alias("blocks"),
    ).select(
        "source_file",
        "header_ord",
        split_quoted_cells(F.col("header")).alias("headers"),
        "blocks",
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """Data lines as a map of header to cell, with a ``reject_reason``.

    A short line lacks its last cells; a long one is rejected.
    """
    cells = F.col("_cells")
    n = F.size("headers")
    usable = lines.where(~F.col("value").startswith("#") & (F.length(strip(F.col("value"))) > 0))
    data = _with_headers(usable, csv_headers(lines)).where(F.col("line_ord") > F.col("header_ord"))
    record = F.map_filter(
        F.map_from_arrays(F.slice("headers", 1, F.size(cells)), cells),
        lambda _, cell: F.length(cell) > 0,
    )
    long = F.size(cells) > n
    parsed = computed_once(
        data.withColumn("_cells", split_quoted_cells(F.col("value"))),
        {
            "reject_reason": F.when(long, "too_many_cells"),
            "record": F.when(~long, record),
        },
    )
    return parsed.drop("_cells", "header_ord")


def csv_points(records: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """Typed CTD points of :func:`csv_records`.

    A file without a time column keeps all its rows; in one with it, rows whose time
    cannot be read are rejected as ``bad_time``. ``keep_rejects`` passes rejected
    lines on with their text and reason, so that one pass gives both.
    """
    record = F.col("record")
    core = ["time"] + CSV_MEASURES
    extra = F.map_filter(record, lambda key, _: ~key.isin(core))
    rejected = F.col("reject_reason").isNotNull()
    late = F.col("time").isNull() & F.array_contains("headers", "time")
    reason = F.coalesce("reject_reason", F.when(late, "bad_time"))
    about = [F.when(rejected, F.col("value")).alias("value"), "reject_reason"]
    return (
        computed_once(records, {"time": table_time(record["time"])})
        .withColumn("reject_reason", reason)
        .where(F.lit(True) if keep_rejects else ~rejected)
        .select(
            "source_file",
            "line_ord",
            "time",
            *[number(record[name]).alias(name) for name in CSV_MEASURES],
            extra.alias("extra"),
            *(about if keep_rejects else []),
        )
    )


def cnv_headers(lines: DataFrame) -> DataFrame:
    """Column names of each profile that has any, in header order, and the blocks of its lines."""
    named = F.col("value").startswith("# name") & F.contains("value", F.lit("="))
    definition = F.substr("value", F.instr("value", "=") + 1)
    name = F.struct("line_ord", strip(F.substring_index(definition, ":", 1)).alias("name"))
    return (
        lines.groupBy("source_file")
        .agg(
            F.array_sort(F.collect_list(F.when(named, name))).alias("_defs"),
            F.collect_set(_block()).alias("blocks"),
        )
        .where(F.size("_defs") > 0)
        .select("source_file", F.transform("_defs", lambda d: d["name"]).alias("columns"), "blocks")
    )


def cnv_records(lines: DataFrame) -> DataFrame:
    """Profile rows as a map of column name to value text.

    Data lines are told from the header by their first character, so a file may
    be split anywhere. Files without column names give no rows.
    """
    text = strip(F.col("value"))
    data = lines.where(~text.rlike("^[*#]") & (F.length(text) > 0))
    cells = F.split(text, r"\s+")
    n = F.least(F.size(cells), F.size("columns"))
    record = F.map_from_arrays(F.slice("columns", F.lit(1), n), F.slice(cells, F.lit(1), n))
    joined = _with_headers(data, cnv_headers(lines))
    return computed_once(joined, {"record": record}).select("source_file", "line_ord", "record")


def measures(record: Column, names: list[str]) -> list[Column]:
    """Named entries of a record map as DOUBLE columns."""
    return [number(record[name]).alias(name) for name in names]


def csv_line_records(lines: DataFrame, headers: list[str]) -> DataFrame:
    """Stream lines against one known header; a line that does not fit is dropped."""
    names = F.array(*[F.lit(h) for h in headers])
    parsed = computed_once(lines, {"record": csv_record(F.col("value"), names)})
    return parsed.where(F.size("record") > 0)


def header_cells(line: str) -> list[str]:
    """Header names of one known header line."""
    return [cell.strip() for cell in line.split(",")]

