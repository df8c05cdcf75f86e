"""Line and file streams over the batch expressions.

Directories are watched by Spark's file source, whose checkpoint is the record
of the files already taken; in production the same functions run on a broker
source, whose rows carry ``value`` and an arrival ``timestamp``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.lines import split_quoted_cells
from marinelake.functions.nmea import gnss_columns, parse_sentences
from marinelake.functions.values import computed_once, is_blank
from marinelake.operators.metadata import batch_results
from marinelake.operators.quality import dedupe_first
from marinelake.options import BATCH_SECONDS, JobOptions
from marinelake.sources.events import reading_record, typed_reading
from marinelake.sources.lines import glob_of_patterns, source_path, split_order

WATERMARK = "10 minutes"


def stream_lines(
    spark: SparkSession,
    path: str,
    patterns: str = "*",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of files as they appear below ``path``, each file once."""
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob_of_patterns(patterns))
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        source_path().alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
        F.make_valid_utf8("value").alias("value"),
    )


def numbered_lines(batch: DataFrame) -> DataFrame:
    """Lines of a micro-batch with their order in the stream, ``line_ord``: that of the
    file, or the broker's offset where the rows carry one."""
    if "line_ord" in batch.columns:
        return batch
    return batch.withColumn("line_ord", split_order(F.col("split_start"))).drop("split_start")


def stream_readings(
    spark: SparkSession, path: str, patterns: str = "*.csv", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Latest readings of small one-row files as they are renamed into place."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob_of_patterns(patterns))
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = F.filter(F.split("value", r"\r?\n"), lambda line: F.length(F.trim(line)) > 0)
    first, second = F.get("_lines", F.lit(0)), F.get("_lines", F.lit(1))
    files = reader.load(path).select(source_path().alias("source_file"), lines.alias("_lines"))
    records = computed_once(files, {"record": reading_record(split_quoted_cells(first), second)})
    return typed_reading(records.drop("_lines"))


def broker_lines(messages: DataFrame) -> DataFrame:
    """Broker rows (``key``, ``offset``, ``value``, ``timestamp``) in the shape of a line
    stream. A key's rows are of one partition, so that the offset is their order."""
    return messages.select(
        F.col("key").cast("string").alias("source_file"),
        F.col("offset").cast("bigint").alias("line_ord"),
        F.col("timestamp").alias("ingest_ts"),
        F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
    )


def stream_sentences(lines: DataFrame) -> DataFrame:
    """GNSS records of a line stream."""
    parsed = parse_sentences(lines.where(~is_blank(F.col("value"))))
    kept = [c for c in lines.columns if c not in ("value", "ingest_ts", "split_start")]
    return parsed.where(F.col("reject_reason").isNull()).select(*kept, *gnss_columns())


def stream_deduplicated(
    records: DataFrame, keys: list[str], watermark: str = WATERMARK
) -> DataFrame:
    """One record per key across micro-batches, as far back as the watermark.

    Which copy is kept is not defined; within a micro-batch, use the keep-first
    sink instead.
    """
    return records.withWatermark("time", watermark).dropDuplicatesWithinWatermark(keys)


def stream_batch_results(
    records: DataFrame, keys: list[str], seconds: int = BATCH_SECONDS, watermark: str = WATERMARK
) -> DataFrame:
    """Counts and ranges per key and batch window, final once the watermark has passed."""
    timed = records.withWatermark("time", watermark)
    bucketed = timed.withColumn("window", F.window("time", f"{seconds} seconds"))
    return batch_results(bucketed, [*keys, "window"]).select(
        *keys, F.col("window.start").alias("batch_start"), "record_count",
        "time_min", "time_max", "lat_min", "lat_max", "lon_min", "lon_max",
    )


def micro_batch_writer(path: str, options: JobOptions) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: keep-first in the batch, then one folder per batch.

    The folder is named by the batch, so a repeated batch replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn("line_ord", F.monotonically_increasing_id())
        keys = ["source_file", "time"]
        rows = dedupe_first(ordered, keys, merge=options.merge_duplicates).drop("line_ord")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
