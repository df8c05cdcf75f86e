"""Tar archives as a scan: members are streamed, never extracted to disk."""

from __future__ import annotations

import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.names import COMPANION_SUFFIXES, FILE_TYPES, has_suffix
from marinelake.paths import arrow_filesystem
from marinelake.sources.lines import glob_of, list_files

LINES_PER_BATCH = 8192

MEMBER_LINE = "archive STRING, member STRING, line_ord BIGINT, value STRING, error STRING"

_SUFFIXES = tuple(
    suffix
    for family, kinds in [*FILE_TYPES.items(), ("companion", COMPANION_SUFFIXES)]
    if family != "archive"
    for suffix in kinds
)


def _open(path: str) -> pa.NativeFile:
    """A sequential reader for a path of any filesystem Arrow knows."""
    filesystem, name = arrow_filesystem(path)
    return filesystem.open_input_stream(name, compression=None)


def _member_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of the regular-file members of each listed archive, batch by batch.

    ``line_ord`` runs through the archive, so it also orders the members. Members that
    are no data files are not read. A damaged archive gives the lines before the damage
    and one row with the ``error``.
    """
    names = ["archive", "member", "line_ord", "value", "error"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, t) for column, t in zip(zip(*rows), types)], names
        )

    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows: list[tuple] = []
            number = 0
            try:
                with _open(path) as raw, tarfile.open(fileobj=raw, mode="r|gz") as tar:
                    for member in tar:
                        if not member.isfile() or not member.name.lower().endswith(_SUFFIXES):
                            continue
                        for line in tar.extractfile(member):
                            text = line.decode("utf-8", errors="replace").rstrip("\r\n")
                            rows.append((path, member.name, number, text, None))
                            number += 1
                            if len(rows) >= LINES_PER_BATCH:
                                yield batch_of(rows)
                                rows = []
            except (tarfile.TarError, OSError, EOFError, zlib.error) as error:
                rows.append((path, None, number, None, f"{type(error).__name__}: {error}"))
            if rows:
                yield batch_of(rows)


def is_safe_member(member: Column) -> Column:
    """Neither absolute nor with a parent reference. Links are not regular files."""
    return ~member.startswith("/") & ~F.contains(member, F.lit(".."))


def is_data_member(member: Column) -> Column:
    suffixes = [s for family, kinds in FILE_TYPES.items() if family != "archive" for s in kinds]
    return has_suffix(member, suffixes + COMPANION_SUFFIXES)


def read_archives(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """Lines of all data members of the archives below ``path``.

    An archive is one compressed stream and so one task, whose memory does not
    grow with the archive. ``tasks`` spreads the archives; by default one task
    per shuffle partition.
    """
    archives = list_files(spark, path, glob_of(FILE_TYPES["archive"])).select("path")
    spread = archives.repartition(tasks, "path") if tasks else archives.repartition("path")
    member = F.col("member")
    return spread.mapInArrow(_member_lines, MEMBER_LINE).where(
        F.col("error").isNotNull() | (is_safe_member(member) & is_data_member(member))
    )


def archive_of(path: Column) -> Column:
    """The archive a member path belongs to; any other path is returned as it is."""
    return F.regexp_replace(path, r"(?i)(\.tar\.gz|\.tgz)/.*$", "$1")


def member_source(lines: DataFrame) -> DataFrame:
    """Archive lines in the shape of a text scan; ``error`` rows are of the archive."""
    return lines.select(
        F.concat_ws("/", "archive", "member").alias("source_file"), "line_ord", "value", "error"
    )
