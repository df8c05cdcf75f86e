"""Text scans with a stable line order, and the file manifest."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.names import file_name, file_type, is_companion
from marinelake.paths import without_scheme


def _case_blind(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def literal_path(path: str) -> str:
    """A path whose characters all stand for themselves, for readers that expand globs."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)


def glob_of(suffixes: list[str]) -> str:
    """Path filter for a list of suffixes in any letter case."""
    return "{" + ",".join("*" + _case_blind(s) for s in suffixes) + "}"


def glob_of_patterns(patterns: str) -> str:
    """Path filter for a comma-separated list of globs."""
    return "{" + ",".join(p.strip() for p in patterns.split(",") if p.strip()) + "}"


# The low bits of a monotonically increasing id count the rows of a partition.
_ROW_BITS = 31
_SPLIT_UNIT = 512


def line_order() -> Column:
    return split_order(F.col("_metadata.file_block_start"))


def split_order(split_start: Column) -> Column:
    """Orders the lines of a file as one BIGINT: split first, then row in the split.

    Exact for splits of 512 bytes and more and files below 2 TiB.
    """
    split = F.floor(split_start / _SPLIT_UNIT)
    row = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    return F.shiftleft(split, _ROW_BITS).bitwiseOR(row)


def source_path() -> Column:
    """The path of the file being read as it is on disk: the scan gives it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_lines(
    spark: SparkSession, path: str | list[str], pattern: str = "*", family: str | None = None
) -> DataFrame:
    """Every line of every matching file below ``path``, of one family if named.

    The family is a condition on the path alone, so files of other families are
    dropped from the scan before any is opened.

    Files are split and packed by the session's ``maxPartitionBytes`` and
    ``openCostInBytes``; ``ingest_ts`` is the file's modification time, so a
    rerun stamps bare sentences alike. A file that vanishes before it is read gives no
    lines.
    """
    files = (
        spark.read.format("text")
        .option("ignoreMissingFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    if family:
        files = files.where(file_type(F.col("_metadata.file_path")) == family)
    return files.select(
        source_path().alias("source_file"),
        line_order().alias("line_ord"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
        F.make_valid_utf8("value").alias("value"),
    )


def read_documents(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """One row per small companion file (header or calibration)."""
    if not path:
        return spark.createDataFrame([], "source_file STRING, content STRING")
    return (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("ignoreMissingFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select(
            source_path().alias("source_file"),
            F.make_valid_utf8("value").alias("content"),
        )
    )


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Files below ``path`` with size and time; the contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("ignoreMissingFiles", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def manifest(spark: SparkSession, path: str | list[str], patterns: str) -> DataFrame:
    """Input files with their family, companions excluded."""
    return route_files(list_files(spark, path, glob_of_patterns(patterns)))


def route_files(files: DataFrame, path: str = "path") -> DataFrame:
    return files.where(~is_companion(F.col(path))).withColumns(
        {
            "source_file": file_name(F.col(path)),
            "file_type": file_type(F.col(path)),
        }
    )


def first_files(files: DataFrame, count: int, path: str = "path") -> DataFrame:
    """The first ``count`` files by path: a top-k, not a global sort."""
    return files.orderBy(path).limit(count)


def outputs_below(files: DataFrame, prefix: str, suffix: str = "", path: str = "path") -> DataFrame:
    """Files whose path, schemes aside, starts with ``prefix`` and ends with ``suffix``."""
    here, wanted = without_scheme(F.col(path)), without_scheme(F.lit(prefix))
    return files.where(F.startswith(here, wanted) & F.endswith(here, F.lit(suffix)))
