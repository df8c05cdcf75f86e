"""File events that drive the ingest job.

A micro-batch of event messages is claimed before its files are read: a path that was
claimed by an earlier message is a duplicate, so a path queued twice is taken in once.
Files are read by their list, never by scanning folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.options import JobOptions
from marinelake.paths import without_scheme
from marinelake.plans.ingest import ingest_files
from marinelake.plans.stream_ingest import Writer, cached
from marinelake.sources.events import file_events
from marinelake.storage import path_exists
from marinelake.streaming.commits import Commits, published_table


def event_batches(out: str, options: JobOptions, source: str = "events", day: Column | None = None) -> Writer:
    """A ``foreachBatch`` writer for messages with ``value`` and ``line_ord``.

    Below ``out/control`` the tables ``events`` (every message with its status: queued,
    duplicate, skipped or error) and ``claims`` (the paths taken in) are published per
    micro-batch; the files' rows and results are runs of the ingest job below ``out``.
    A path that is not there is an error and is not claimed, so a later event may bring
    it. A micro-batch that failed after its files were read reads them again as a new
    run, which replaces the first one in the current view.

    The driver gets the new paths of one micro-batch, whose number the source's rate
    limit bounds."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = Commits(spark, f"{out}/control", source)
        if commits.published(batch_id):
            return
        claimed = spark.createDataFrame([], "claim STRING")
        if commits.facts_before(batch_id):
            claimed = published_table(spark, f"{out}/control", "claims", source).select("claim")
        with cached() as kept:
            events = kept(file_events(batch).withColumn("claim", without_scheme(F.col("file"))))
            first = events.where(F.col("status") == "queued").groupBy("claim").agg(
                F.min("line_ord").alias("first"), F.min_by("file", "line_ord").alias("file")
            )
            new = sorted((r["claim"], r["file"]) for r in first.join(claimed, "claim", "left_anti").select("claim", "file").collect())
            there = [(claim, file) for claim, file in new if path_exists(spark, file)]
            state = spark.createDataFrame(
                [(claim, (claim, file) in set(there)) for claim, file in new], "claim STRING, found BOOLEAN"
            )
            judged = events.join(state, "claim", "left").join(first.select("claim", "first"), "claim", "left")
            queued, found = F.col("status") == "queued", F.col("found")
            missing = queued & found.isNotNull() & ~found
            again = queued & (found.isNull() | (F.col("line_ord") > F.col("first")))
            statuses = judged.withColumns(
                {
                    "status": F.when(missing, "error").when(again, "duplicate").otherwise(F.col("status")),
                    "reason": F.when(missing, F.concat(F.lit("file not found: "), "file")).otherwise(F.col("reason")),
                }
            ).drop("claim", "found", "first")
            if there:
                ingest_files(spark, [file for _, file in there], out, options, day)
            claims = state.where("found").select("claim")
            commits.write(batch_id, {"events": statuses, "claims": claims}, {"claims": True})

    return write
