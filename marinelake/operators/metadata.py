"""Per-file metadata, statistics and results; every one a map-side combined aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.operators.quality import has_position
from marinelake.schemas import STATISTIC_COLUMNS


def _extent() -> list[Column]:
    valid = has_position()
    return [
        how(F.when(valid, F.col(column))).alias(f"{column[:3]}_{how.__name__}")
        for column in ("latitude", "longitude")
        for how in (F.min, F.max)
    ]


def written_count() -> Column:
    """Rows the position filter lets through."""
    located = F.count_if(has_position())
    return F.when(located > 0, located).otherwise(F.count(F.lit(1)))


def file_metadata(df: DataFrame, source: str = "source_file", columns: list[str] | None = None) -> DataFrame:
    """Counts, filled columns, time range and extent of each file.

    Columns are those of the file: what the job adds is left out, and the names in
    ``extra`` are listed in its place.
    """
    added = (source, "line_ord", "extra", "file_type", "provider", "attributes")
    listed = columns or [c for c in df.columns if c not in added]
    filled = F.array_compact(
        F.array(*[F.when(F.count(F.col(c)) > 0, F.lit(c)) for c in listed])
    )
    if columns is None and "extra" in df.columns:
        names = F.array_distinct(F.flatten(F.collect_set(F.map_keys("extra"))))
        filled = F.concat(filled, F.array_sort(F.array_except(names, filled)))
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("record_count"),
        written_count().alias("written_count"),
        filled.alias("columns"),
        F.min("time").alias("time_start"),
        F.max("time").alias("time_end"),
        *_extent(),
    )


def statistics_columns(df: DataFrame) -> list[str]:
    return [c for c in STATISTIC_COLUMNS if c in df.columns]


def sensor_stats(df: DataFrame, source: str = "source_file") -> DataFrame:
    """Min, max and mean of the statistic columns as a map; empty columns are left out."""
    present = statistics_columns(df)
    entries = [
        F.when(
            F.count(c) > 0,
            F.struct(
                F.lit(c).alias("key"),
                F.struct(
                    F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean")
                ).alias("value"),
            ),
        )
        for c in present
    ]
    return df.groupBy(source).agg(
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("sensor_stats")
    )


def sensor_stats_long(df: DataFrame, source: str = "source_file") -> DataFrame:
    """The same, one row per file and sensor."""
    return sensor_stats(df, source).select(
        source, F.explode("sensor_stats").alias("sensor", "_s")
    ).select(source, "sensor", "_s.*")


def ranges() -> list[Column]:
    """Least and greatest time, latitude and longitude."""
    return [
        how(column).alias(f"{name}_{how.__name__}")
        for column, name in (("time", "time"), ("latitude", "lat"), ("longitude", "lon"))
        for how in (F.min, F.max)
    ]


def file_results(
    manifest: DataFrame, records: DataFrame, errors: DataFrame | None = None, gone: DataFrame | None = None
) -> DataFrame:
    """One result per file, listed or with records: ok, skipped without records, or error.

    ``errors`` has ``source_file`` and ``error``; ``gone`` has ``source_file`` of the files
    that vanished, an error where they gave no records."""
    counted = records.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("record_count"), *ranges()
    )
    joined = manifest.join(counted, "source_file", "full")
    if errors is None:
        joined = joined.withColumn("error", F.lit(None).cast("string"))
    else:
        joined = joined.join(
            errors.groupBy("source_file").agg(F.min("error").alias("error")), "source_file", "left"
        )
    empty = F.col("record_count").isNull()
    if gone is not None:
        lost = gone.select("source_file").distinct().withColumn("_gone", F.lit(True))
        joined = joined.join(lost, "source_file", "left").withColumn(
            "error", F.coalesce("error", F.when(empty & F.col("_gone"), "file vanished"))
        ).drop("_gone")
    return joined.withColumns(
        {
            "status": F.when(F.col("error").isNotNull(), "error")
            .when(empty, "skipped")
            .otherwise("ok"),
            "reason": F.when(F.col("error").isNull() & empty, "no records parsed"),
            "record_count": F.coalesce("record_count", F.lit(0)),
        }
    )


def batch_results(df: DataFrame, keys: list[str]) -> DataFrame:
    """Result of each stream batch; ``keys`` name the batch."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"), *ranges())


def run_summary(results: DataFrame) -> DataFrame:
    """Files by status and records in all."""
    status = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(status == "ok").alias("ok"),
        F.count_if(status == "skipped").alias("skipped"),
        F.count_if(status == "error").alias("errors"),
        F.coalesce(F.sum(F.when(status == "ok", F.col("record_count"))), F.lit(0)).alias(
            "total_records"
        ),
    )
