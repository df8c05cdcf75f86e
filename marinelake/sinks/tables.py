"""Partitioned Parquet outputs, metadata and telemetry payloads."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.functions.names import campaign_name
from marinelake.options import JobOptions
from marinelake.operators.metadata import file_metadata, sensor_stats
from marinelake.operators.quality import valid_positions
from marinelake.session import remove_dir
from marinelake.sinks.geoparquet import read_committed, write_committed
from marinelake.sources.lines import list_files
from marinelake.storage import path_exists

LAYOUT = ["campaign", "dataset", "ingest_date"]


def with_layout(df: DataFrame, options: JobOptions, day: Column | None = None) -> DataFrame:
    """Add the partition columns ``campaign/dataset/ingest_date``."""
    return df.withColumns(
        {
            "campaign": campaign_name(F.lit(options.campaign_id or "default")),
            "dataset": F.lit(options.dataset),
            "ingest_date": F.to_date(day if day is not None else F.current_timestamp()),
        }
    )


def write_table(
    df: DataFrame,
    path: str,
    options: JobOptions,
    day: Column | None = None,
    files_per_day: int | None = None,
    run: str | None = None,
) -> None:
    """Write the positioned rows; a rerun replaces the days it touches.

    With a ``run`` the rows are added below ``run=...`` and nothing is replaced:
    :func:`current_table` reads each file's rows of its latest run.

    Rows are clustered by ``source_file`` and time so that readers can skip row
    groups. Days are range-split, never one task per day or per file.
    """
    placed = _placed(with_layout(valid_positions(df), options, day), files_per_day)
    if run:
        placed.withColumn("run", F.lit(run)).write.mode("append").partitionBy(*LAYOUT, "run").parquet(path)
    else:
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *LAYOUT
        ).parquet(path)


def _placed(laid: DataFrame, files_per_day: int | None = None) -> DataFrame:
    order = [*LAYOUT, "source_file", "time"]
    spread = (
        laid.repartitionByRange(files_per_day, *order)
        if files_per_day
        else laid.repartitionByRange(*order)
    )
    return spread.sortWithinPartitions(*order)


def write_geo_table(df: DataFrame, out: str, options: JobOptions, day: Column | None, run: str) -> None:
    """The positioned rows as GeoParquet, laid out as by :func:`write_table`, as one run
    of the table ``geo`` below ``out``."""
    _add_geo_run(with_layout(valid_positions(df), options, day), out, run)


def _add_geo_run(laid: DataFrame, out: str, run: str) -> None:
    rows = _placed(laid).withColumn("run", F.lit(run))
    write_committed(rows, f"{out}/geo", f"{out}/commits/geo", run, [*LAYOUT, "run"])


def new_run() -> str:
    """A name for a run; later runs have later names."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


#: Status of the run of a file that a table's current rows are of. A run that failed for
#: a file or found nothing in it leaves the file's earlier rows; ``results`` shows it.
_COUNTS = {"data": ("ok",), "geo": ("ok",), "metadata": ("ok",), "rejects": ("ok", "skipped")}


def current_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Rows of an output table that hold now: of each file those of its latest run that
    did not fail for it.

    A run counts once its results are written, which is its last step; what a failed
    run left behind is not seen.
    """
    return _current(spark, out, name).drop("run")


def _current(spark: SparkSession, out: str, name: str) -> DataFrame:
    results = spark.read.option("mergeSchema", "true").parquet(f"{out}/results")
    if name in _COUNTS:
        results = results.where(F.col("status").isin(*_COUNTS[name]))
    latest = results.groupBy("source_file").agg(F.max("run").alias("run"))
    if name == "geo":
        table = read_committed(spark, f"{out}/geo", f"{out}/commits/geo")
    else:
        table = spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}")
    return table.join(latest, ["source_file", "run"], "left_semi")


def compact(spark: SparkSession, out: str) -> str:
    """Rewrite what holds now as one run and return its name; the runs before it stay
    readable until :func:`expire_runs`.

    Of each file the result that goes with its current rows is kept, or its latest."""
    run = new_run()
    every = spark.read.option("mergeSchema", "true").parquet(f"{out}/results")
    order = F.struct((F.col("status") == "ok").alias("ok"), "run")
    kept = every.groupBy("source_file").agg(F.max_by(F.struct(*[c for c in every.columns if c not in ("source_file", "run")]), order).alias("_r"))
    if path_exists(spark, f"{out}/data"):
        data = _placed(_current(spark, out, "data").drop("run"))
        data.withColumn("run", F.lit(run)).write.mode("append").partitionBy(*LAYOUT, "run").parquet(f"{out}/data")
    if path_exists(spark, f"{out}/commits/geo"):
        _add_geo_run(_current(spark, out, "geo").drop("run", "geometry"), out, run)
    for name in ("metadata", "rejects"):
        _current(spark, out, name).drop("run").write.parquet(f"{out}/{name}/run={run}")
    kept.select("source_file", "_r.*").write.parquet(f"{out}/results/run={run}")
    return run


def expire_runs(spark: SparkSession, out: str, before: str) -> None:
    """Delete all runs earlier than ``before``, the name of a run that :func:`compact`
    gave; results go first, so that no reader finds a run whose rows are gone."""
    for name in ("results", "commits/geo", "rejects", "metadata", "data", "geo"):
        if not path_exists(spark, f"{out}/{name}"):
            continue
        if name == "commits/geo":
            # A run's list is one file; without it none of the run's files is read.
            lists = list_files(spark, f"{out}/{name}").where(F.regexp_extract("path", r"/([^/]*)\.json$", 1) < before)
            for row in lists.select("path").toLocalIterator():
                remove_dir(spark, row["path"])
            continue
        folder = F.regexp_extract("path", r"^(.*/run=[^/]*)/[^/]*$", 1)
        run = F.regexp_extract("path", r"/run=([^/]*)/[^/]*$", 1)
        # One row per run and day.
        old = list_files(spark, f"{out}/{name}").where(run < before).select(folder.alias("f")).distinct()
        for row in old.toLocalIterator():
            remove_dir(spark, row["f"])


def metadata_table(df: DataFrame) -> DataFrame:
    """Metadata and statistics of each file in one row."""
    stats = sensor_stats(df)
    return file_metadata(df).join(stats, "source_file", "left")


def write_metadata(df: DataFrame, path: str, as_json: bool = False) -> None:
    writer = metadata_table(df).write.mode("overwrite")
    writer.json(path) if as_json else writer.parquet(path)


def batch_summary(results: DataFrame, options: JobOptions, key: str) -> DataFrame:
    """Results of stream batches as messages: the source is the stream, and no provider
    is named."""
    return telemetry(results.withColumn("source", F.lit("stream")), options, key)


def telemetry(df: DataFrame, options: JobOptions, key: str, summary: bool = False) -> DataFrame:
    """Rows as ``key`` and JSON ``value``, ready for a broker or a table.

    ``summary`` is the form of file results, which names the provider."""
    extra = [
        F.lit(options.campaign_id).alias("campaign_id"),
        F.lit(options.platform_id).alias("platform_id"),
    ]
    if summary:
        extra.append(F.lit(options.provider).alias("provider"))
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns, *extra)).alias("value"),
    )
