"""Live streams into the same tables as the ingest job, micro-batch by micro-batch.

Each function gives a ``foreachBatch`` writer. A micro-batch is parsed once, and its good
rows, its rejected lines and its result are published together by
:class:`marinelake.streaming.commits.Commits`, so a micro-batch that Spark repeats after a
failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.functions.lines import csv_record, split_cells
from marinelake.functions.values import computed_once
from marinelake.operators.casts import with_coefficients
from marinelake.operators.enrich import rules_enrichment
from marinelake.operators.metadata import batch_results, ranges
from marinelake.operators.quality import dedupe_first, split_rejects, valid_positions
from marinelake.options import JobOptions
from marinelake.plans.ingest import calibrated_scans, sentence_points
from marinelake.sinks.tables import batch_summary, with_layout
from marinelake.sources.casts import parse_calibration, parse_header
from marinelake.sources.tables import csv_points
from marinelake.streaming.commits import Commits, published_table
from marinelake.streaming.lines import numbered_lines
from marinelake.streaming.sequences import stream_with_headers

Writer = Callable[[DataFrame, int], None]


@contextmanager
def cached() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables of a micro-batch that are read more than once, released at its end."""
    tables: list[DataFrame] = []

    def kept(rows: DataFrame) -> DataFrame:
        tables.append(rows.persist())
        return tables[-1]

    try:
        yield kept
    finally:
        for rows in tables:
            rows.unpersist()


def batch_result(records: DataFrame, rejects: DataFrame, batch_id: int) -> DataFrame:
    """One row: the micro-batch with its counts and ranges; without records ``skipped``."""
    counted = records.agg(F.count(F.lit(1)).alias("record_count"), *ranges())
    lost = rejects.agg(F.count(F.lit(1)).alias("reject_count"))
    empty = F.col("record_count") == 0
    return counted.crossJoin(lost).withColumns(  # one row and one row
        {
            "batch_id": F.lit(batch_id).cast("bigint"),
            "status": F.when(empty, "skipped").otherwise("ok"),
            "reason": F.when(empty, "empty batch"),
        }
    )


def batch_tables(
    points: DataFrame, batch_id: int, options: JobOptions, kept: Callable[[DataFrame], DataFrame], day: Column | None = None
) -> dict[str, DataFrame]:
    """What a micro-batch of parsed lines writes; ``kept`` caches what is read more than once.

    ``points`` have ``source_file, line_ord, time``, their measures, ``value`` and
    ``reject_reason``. Keep-first is per stream and time within the micro-batch; rows
    without a time are rejected before and so never tell each other out."""
    good, bad = split_rejects(points)
    single = dedupe_first(good.drop("value"), ["source_file", "time"], merge=options.merge_duplicates)
    records = kept(rules_enrichment(single, list(options.provider_rules), name=options.provider))
    rejects = bad.select("source_file", "line_ord", "value", "reject_reason")
    results = batch_result(records, rejects, batch_id)
    return {
        "data": with_layout(valid_positions(records), options, day),
        "rejects": rejects,
        "results": results.drop("batch_id"),
        "telemetry": batch_summary(results, options, "batch_id"),
    }


def sentence_batches(out: str, options: JobOptions, source: str = "stream", day: Column | None = None) -> Writer:
    """GNSS lines of :func:`marinelake.streaming.lines.stream_lines` or of a broker."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commits = Commits(batch.sparkSession, out, source)
        if commits.published(batch_id):
            return
        with cached() as kept:
            points = kept(sentence_points(numbered_lines(batch)))
            commits.write(batch_id, batch_tables(points, batch_id, options, kept, day))

    return write


def csv_stream(lines: DataFrame, header: Column | None = None, max_held: int | None = None) -> DataFrame:
    """Typed points of CSV lines against the header in force in their stream.

    By default a line is a header if one of its cells is ``time``. Lines before the first
    header of their stream wait for it, however many they are; only with ``max_held`` are
    they rejected as ``no_header`` once more than that wait. A line with another number of
    cells is rejected as ``cell_count``."""
    names = F.transform(split_cells(F.col("value")), F.lower)
    marked = F.array_contains(names, "time") if header is None else header
    found = stream_with_headers(lines, ["source_file"], marked, most=max_held)
    headers = split_cells(F.col("header"))
    parsed = computed_once(found.withColumn("headers", headers), {"record": csv_record(F.col("value"), F.col("headers"))})
    reason = F.when(F.col("header").isNull(), "no_header").when(F.col("record").isNull(), "cell_count")
    return csv_points(parsed.withColumn("reject_reason", reason), keep_rejects=True)


def point_batches(out: str, options: JobOptions, source: str = "stream", day: Column | None = None) -> Writer:
    """Points parsed by the stream itself, such as those of :func:`csv_stream`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        commits = Commits(batch.sparkSession, out, source)
        if commits.published(batch_id):
            return
        with cached() as kept:
            commits.write(batch_id, batch_tables(kept(batch), batch_id, options, kept, day))

    return write


_PREAMBLE = ["source_file", "version", "header", "xmlcon"]


def scan_batches(out: str, options: JobOptions, source: str = "scans", day: Column | None = None) -> Writer:
    """Scans and preambles of :func:`marinelake.streaming.sequences.stream_scans`.

    Preambles go to the table ``preambles``, and every scan is joined to the one it names,
    of this micro-batch or an earlier one: one row per stream and version. A scan whose
    preamble has no calibration, or that has none, keeps its text in ``hex_scan`` and has
    no measures. All scans are kept, whatever their times; other lines are rejected."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = Commits(spark, out, source)
        if commits.published(batch_id):
            return
        with cached() as kept:
            rows = kept(batch)
            new = rows.where(F.col("role") == "preamble").select(*_PREAMBLE)
            known = new
            if commits.facts_before(batch_id):
                known = known.unionByName(published_table(spark, out, "preambles", source).select(*_PREAMBLE))
            # A stream and a version in place of a cast's folder and stem.
            cast = {"dir": F.col("source_file"), "stem_lc": F.col("version").cast("string")}
            headers = parse_header(known.withColumns(cast).select("dir", "stem_lc", "source_file", F.col("header").alias("content")))
            with_text = known.where(F.length("xmlcon") > 0).withColumns(cast)
            calibrations = with_coefficients(parse_calibration(with_text.select("dir", "stem_lc", "source_file", F.col("xmlcon").alias("content"))))
            scans = rows.where(F.col("role") == "scan").withColumns(cast).select(
                "source_file", "line_ord", "scan", *cast, F.trim("value").alias("hex_scan")
            )
            keys = list(cast)
            blind = scans.join(calibrations.select(*keys), keys, "left_anti").drop(*keys)
            seen = calibrated_scans(scans.join(calibrations.select(*keys), keys, "left_semi"), headers, calibrations)
            records = kept(seen.unionByName(blind, allowMissingColumns=True))
            rejects = rows.where(F.col("role") == "ignore").select("source_file", "line_ord", "value", F.lit("not_a_scan").alias("reject_reason"))
            results = batch_result(records, rejects, batch_id)
            tables = {
                "data": with_layout(valid_positions(records), options, day),
                "preambles": new,
                "rejects": rejects,
                "results": results.drop("batch_id"),
                "telemetry": batch_summary(results, options, "batch_id"),
            }
            commits.write(batch_id, tables, {"preambles": True})

    return write


def window_batches(
    out: str, keys: list[str], seconds: int, delay_seconds: int, source: str = "windows"
) -> Writer:
    """Counts and ranges per key and window of event time, each window written once, and
    every late record listed.

    The watermark of a micro-batch is the newest time of all before it less the delay, as
    in Spark's own; it only rises. Records behind it go to ``rejects`` as ``late`` and
    those without a time as ``bad_time``, the others to ``data``. A window is written to
    ``windows`` by the micro-batch that moves the watermark past its end, from the
    published records of its time range: the records already written are the only state,
    and no window is read before it is complete."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = Commits(spark, out, source)
        if commits.published(batch_id):
            return
        before = commits.facts_before(batch_id).get("watermark_us")
        at = F.unix_micros("time")
        with cached() as kept:
            rows = kept(batch.withColumn("time", F.col("time").cast("timestamp")))
            newest = rows.agg(F.max(at)).first()[0]
            marks = [us for us in (before, None if newest is None else newest - delay_seconds * 1_000_000) if us is not None]
            after = max(marks, default=None)
            reason = F.when(F.col("time").isNull(), "bad_time").when(at < F.lit(before), "late")
            marked = rows.withColumn("reject_reason", reason)
            good, bad = split_rejects(marked)
            tables = {"data": good, "rejects": bad}
            first, last = (None if us is None else us - us % (seconds * 1_000_000) for us in (before, after))
            closed = good
            if before is not None:
                earlier = published_table(spark, out, "data", source).select(*good.columns)
                closed = earlier.where(F.col("time") >= F.timestamp_micros(F.lit(first))).unionByName(good)
            closed = closed.where(F.col("time") < F.timestamp_micros(F.lit(last)))
            bucketed = closed.withColumn("window", F.window("time", f"{seconds} seconds"))
            tables["windows"] = batch_results(bucketed, [*keys, "window"]).withColumn("window_start", F.col("window.start")).drop("window")
            commits.write(batch_id, tables, {"watermark_us": after})

    return write


def run_batches(stream: DataFrame, writer: Writer, checkpoint: str) -> None:
    """Take in all there is now; the next call goes on where this one ended."""
    stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
