"""One job over a whole directory of instrument files.

Every family is one lazy DataFrame over all of its files. The parsed, enriched
and de-duplicated rows are written once to a columnar staging table in the
shared folder; the data, metadata and result tables are read from it, so text is
parsed once and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.names import file_type, is_companion
from marinelake.functions.nmea import gnss_columns, parse_sentences
from marinelake.functions.values import number
from marinelake.operators.casts import (
    calibrate,
    cast_position,
    companion_join,
    decode_scans,
    smoothed_compensation,
    with_cast_key,
    with_coefficients,
)
from marinelake.operators.currents import adcp_ensembles
from marinelake.operators.enrich import rules_enrichment
from marinelake.operators.metadata import file_results, run_summary
from marinelake.operators.quality import concat_members, dedupe_records, split_rejects
from marinelake.operators.sequence import scan_number
from marinelake.options import JobOptions
from marinelake.session import configure, remove_dir, scratch_dir
from marinelake.sinks.tables import current_table, new_run, write_geo_table, write_metadata, write_table
from marinelake.sources.archives import archive_of, member_source, read_archives
from marinelake.sources.casts import parse_calibration, parse_header, scan_lines
from marinelake.sources.lines import glob_of, glob_of_patterns, list_files, literal_path, manifest, read_documents, read_lines
from marinelake.sources.tables import cnv_records, csv_points, csv_records
from marinelake.storage import path_exists

def sentence_points(lines: DataFrame) -> DataFrame:
    """GNSS records; lines that gave none keep their text and reason and lose their time."""
    good = F.col("reject_reason").isNull()
    return parse_sentences(lines).select(
        "source_file",
        "line_ord",
        F.when(good, F.col("time")).alias("time"),
        *[c for c in gnss_columns() if c != "time"],
        F.when(~good, F.col("value")).alias("value"),
        "reject_reason",
    )


def cnv_points(lines: DataFrame) -> DataFrame:
    """Profile rows; position typed, every other column by its own name in ``extra``."""
    record = F.col("record")
    position = ["latitude", "longitude"]
    return cnv_records(lines).select(
        "source_file",
        "line_ord",
        *[number(record[c]).alias(c) for c in position],
        F.map_filter(record, lambda k, _: ~k.isin(position)).alias("extra"),
    )


def cast_points(lines: DataFrame, headers: DataFrame, calibrations: DataFrame) -> DataFrame:
    """Numbered, positioned and calibrated scans of all casts."""
    return calibrated_scans(with_cast_key(scan_number(scan_lines(lines))), headers, calibrations, smooth=True)


def calibrated_scans(scans: DataFrame, headers: DataFrame, calibrations: DataFrame, smooth: bool = False) -> DataFrame:
    """Scans decoded and calibrated by the companions of their cast; ``smooth`` averages
    the compensation count of the pressure sensor, which needs whole casts."""
    decoded = decode_scans(companion_join(scans, headers, calibrations))
    if smooth:
        decoded = smoothed_compensation(decoded, ["source_file"])
    points = cast_position(calibrate(decoded))
    return points.select(
        "source_file", "line_ord", "station", "time", "latitude", "longitude", "depth",
        "temperature", "conductivity", "pressure", "salinity", "temperature_freq",
        "conductivity_freq", "pressure_freq", "temperature_comp", "temperature2_freq",
        "conductivity2_freq", "temperature2", "conductivity2", "salinity2", *[f"volt{i}" for i in range(8)], "scan", "hex_scan",
    )


def _staged_members(spark: SparkSession, path: str | list[str], staging: str) -> DataFrame:
    """Archive lines, unpacked once into a table by family in the shared folder.

    The family ``error`` holds the archives that could not be read to their end.
    """
    member = member_source(read_archives(spark, path))
    kind = (
        F.when(F.col("error").isNotNull(), "error")
        .when(is_companion(F.col("source_file")), "companion")
        .otherwise(file_type(F.col("source_file")))
    )
    member.withColumns({"family": kind, "value": F.coalesce("value", "error")}).drop("error").write.partitionBy(
        "family"
    ).parquet(staging)
    schema = "source_file STRING, line_ord BIGINT, value STRING, family STRING"
    return spark.read.schema(schema).parquet(staging).withColumn("ingest_ts", F.current_timestamp())


def _documents_of(lines: DataFrame) -> DataFrame:
    """Companion members of archives, whole; a companion is a small file."""
    line = F.struct("line_ord", "value")
    return (
        lines.groupBy("source_file")
        .agg(F.array_sort(F.collect_list(line)).alias("_lines"))
        .select(
            "source_file",
            F.concat_ws("\n", F.transform("_lines", lambda x: x["value"])).alias("content"),
        )
    )


def parse_directory(
    spark: SparkSession,
    path: str | list[str],
    options: JobOptions,
    pings: DataFrame | None = None,
    unpacked: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Text records with their rejected lines, gridded and cast records, and errors.

    The first are subject to keep-first, the second are not; the third have
    ``source_file`` and ``error``. ``path`` is a folder or a list of files, whose casts
    find their companions in their own folders. ``unpacked`` is where archives are
    unpacked.
    """
    listed = isinstance(path, list)
    glob = "*" if listed else glob_of_patterns(options.watch_patterns)
    beside = sorted({os.path.dirname(p) for p in path if p.lower().endswith(".hex")}) if listed else path
    members = _staged_members(spark, path, unpacked or scratch_dir(spark, "members"))

    def lines(family: str) -> DataFrame:
        inside = members.where(F.col("family") == family).drop("family")
        return read_lines(spark, path, glob, family).unionByName(inside)

    def documents(suffix: str) -> DataFrame:
        inside = members.where(
            (F.col("family") == "companion") & F.lower("source_file").endswith(suffix)
        )
        return read_documents(spark, beside, glob_of([suffix])).unionByName(_documents_of(inside))

    rows = csv_records(lines("csv").where(~is_companion(F.col("source_file"))))
    text = concat_members(
        [
            sentence_points(lines("nmea")),
            csv_points(rows, keep_rejects=True),
            cnv_points(lines("cnv")),
        ]
    )
    casts = cast_points(
        lines("hex"),
        with_cast_key(parse_header(documents(".hdr"))),
        with_cast_key(with_coefficients(parse_calibration(documents(".xmlcon")))),
    )
    whole = [casts]
    if pings is not None:
        whole.append(adcp_ensembles(pings))

    errors = members.where(F.col("family") == "error").select("source_file", F.col("value").alias("error"))
    return _by_file(text), _by_file(concat_members(whole)), errors


def _by_file(records: DataFrame) -> DataFrame:
    """Family of the parsed file, then the file the rows are reported under."""
    return records.withColumns(
        {
            "file_type": file_type(F.col("source_file")),
            "source_file": archive_of(F.col("source_file")),
        }
    )


def ingest_directory(
    spark: SparkSession,
    path: str,
    out: str,
    options: JobOptions,
    day: Column | None = None,
    pings: DataFrame | None = None,
) -> DataFrame:
    """Read, normalise and write all files below ``path``; returns the result per file.

    Adds a run to ``data`` (``geo`` with the option ``geoparquet``), ``metadata``, ``rejects`` and ``results`` below ``out``;
    :func:`current_table` reads what holds now. A file that is taken in again replaces
    its own rows and no others. The results are written last and make the run count.
    A damaged archive, or a file that vanishes before it is read, gets the status
    ``error`` and does not stop the others.
    """
    return _ingest(configure(spark), path, options.watch_patterns, None, out, options, day, pings)


def ingest_files(
    spark: SparkSession, paths: list[str], out: str, options: JobOptions, day: Column | None = None
) -> DataFrame:
    """The same for a list of files of any name, as of one micro-batch of file events.

    A file that is not there gets the status ``error`` and the reason. The driver asks
    the file system for each path once."""
    configure(spark)
    wanted = list(dict.fromkeys(paths))
    there = [p for p in wanted if path_exists(spark, p)]
    missing = spark.createDataFrame(
        [(p, f"file not found: {p}") for p in wanted if p not in set(there)], "source_file STRING, error STRING"
    )
    return _ingest(spark, [literal_path(p) for p in there], "*", missing, out, options, day, None)


def _ingest(
    spark: SparkSession, path: str | list[str], patterns: str, missing: DataFrame | None, out: str,
    options: JobOptions, day: Column | None, pings: DataFrame | None,
) -> DataFrame:
    run, unpacked = new_run(), scratch_dir(spark, "members")
    if not path:
        return _missing_only(missing, f"{out}/results/run={run}")
    # Kept, as a listing that is read later does not know the files that are gone by then.
    at_first = scratch_dir(spark, "manifest")
    manifest(spark, path, patterns).select(F.col("path").alias("source_file"), "file_type", "length").write.parquet(at_first)
    listed = spark.read.parquet(at_first)
    text, whole, errors = parse_directory(spark, path, options, pings, unpacked)
    if missing is not None:
        listed = listed.unionByName(missing.select("source_file", file_type(F.col("source_file")).alias("file_type")), allowMissingColumns=True)
        errors = errors.unionByName(missing)
    single = dedupe_records(text, merge=options.merge_duplicates)
    records = concat_members([single, whole])
    staging = scratch_dir(spark, "staging")
    enriched = rules_enrichment(records, list(options.provider_rules), name=options.provider)
    enriched.write.parquet(staging)
    clean, rejects = split_rejects(spark.read.parquet(staging))
    clean = clean.drop("value")

    if options.geoparquet:
        write_geo_table(clean, out, options, day, run)
    else:
        write_table(clean, f"{out}/data", options, day, run=run)
    write_metadata(clean, f"{out}/metadata/run={run}")
    rejects.select("source_file", "line_ord", "value", "reject_reason").write.parquet(f"{out}/rejects/run={run}")
    # Listed again: what is no longer there may not have been read.
    left = [p for p in path if path_exists(spark, _plain(p))] if isinstance(path, list) else path
    now = list_files(spark, left).select(F.col("path").alias("source_file")) if left else listed.select("source_file").limit(0)
    gone = listed.join(now, "source_file", "left_anti")
    results = file_results(listed, clean, errors, gone)
    # Pings are of files that are not listed.
    typed = results.withColumn("file_type", F.coalesce("file_type", file_type(F.col("source_file"))))
    typed.write.parquet(f"{out}/results/run={run}")
    for folder in (staging, unpacked, at_first):
        remove_dir(spark, folder)
    return spark.read.parquet(f"{out}/results/run={run}")


def _plain(path: str) -> str:
    return re.sub(r"\\(.)", r"\1", path)


def _missing_only(missing: DataFrame, place: str) -> DataFrame:
    """Results of a run none of whose files is there."""
    nothing = missing.sparkSession.createDataFrame(
        [], "source_file STRING, time TIMESTAMP, latitude DOUBLE, longitude DOUBLE"
    )
    listed = missing.select(
        "source_file", file_type(F.col("source_file")).alias("file_type"), F.lit(None).cast("bigint").alias("length")
    )
    file_results(listed, nothing, missing).write.parquet(place)
    return missing.sparkSession.read.parquet(place)


__all__ = ["current_table", "ingest_directory", "ingest_files", "parse_directory", "run_summary"]
