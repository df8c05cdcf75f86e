"""Sequence operators that stay parallel when one key holds most of the rows.

A plain window over a key sends the whole key to one task. Here the sequence of
a key is cut into blocks of its order column; windows run per ``(key, block)``
and a small per-block table carries what has to cross a block edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marinelake.options import BATCH_MAX_RECORDS, BATCH_SECONDS, RECORD_GAP_SECONDS

# Values of the order column per block: 2**16.
BLOCK_BITS = 16


def _block(order: str) -> Column:
    return F.shiftright(F.col(order).cast("bigint"), BLOCK_BITS)


def _join_blocks(rows: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what is known of their block; null keys and orders match too."""
    on = [*keys, "_block"]
    renamed = blocks.withColumnsRenamed({c: f"_of_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on]
    return rows.join(renamed, same).drop(*[f"_of_{c}" for c in on])


def with_position(
    df: DataFrame, keys: list[str], order: str, name: str = "position"
) -> DataFrame:
    """Number the rows of each key 1..n by a unique BIGINT ``order``."""
    cut = df.withColumn("_block", _block(order))
    sizes = cut.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        *keys, "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    return (
        _join_blocks(cut, starts, keys)
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop("_block", "_start")
    )


def with_previous(
    df: DataFrame, keys: list[str], order: str, value: str, name: str
) -> DataFrame:
    """Add ``value`` of the previous row of the key by a unique BIGINT ``order``.

    Null keys are a key, and rows without an order come first.
    """
    cut = df.withColumn("_block", _block(order))
    lasts = cut.groupBy(*keys, "_block").agg(F.max_by(value, order).alias("_last"))
    edges = lasts.select(
        *keys,
        "_block",
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_block")).alias("_before"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    first = F.row_number().over(inside) == 1
    return (
        _join_blocks(cut, edges, keys)
        .withColumn(
            name,
            F.when(first, F.col("_before")).otherwise(F.lag(value).over(inside)),
        )
        .drop("_block", "_before")
    )


def moving_average(
    df: DataFrame, keys: list[str], position: str, value: str, before: int, after: int, name: str,
    block: int = 1 << BLOCK_BITS,
) -> DataFrame:
    """Add the mean of ``value`` from ``before`` rows before each row to ``after`` rows
    after it, fewer at the ends of a key; nulls are skipped.

    ``position`` numbers the rows of a key from 1 on. A key is cut into blocks of
    positions, and the rows near an edge are copied into the blocks whose means need
    them, ``before + after`` rows per block, so that no key is one task.
    """
    at = F.col(position) - 1

    def block_at(place: Column) -> Column:
        return F.floor(place / block).cast("bigint")

    first, last = block_at(F.greatest(at - after, F.lit(0))), block_at(at + before)
    spread = df.withColumns({"_own": block_at(at), "_block": F.explode(F.sequence(first, last))})
    near = Window.partitionBy(*keys, "_block").orderBy(position).rangeBetween(-before, after)
    return (
        spread.withColumn(name, F.avg(value).over(near))
        .where(F.col("_block") == F.col("_own"))
        .drop("_own", "_block")
    )


def changed_readings(
    df: DataFrame, keys: list[str], order: str = "line_ord", time: str = "time"
) -> DataFrame:
    """Rows whose time differs from that of the reading before; the first is kept."""
    return (
        with_previous(df, keys, order, time, "_previous")
        .where(~F.col("_previous").eqNullSafe(F.col(time)))
        .drop("_previous")
    )


def scan_number(df: DataFrame, order: str = "line_ord", name: str = "scan") -> DataFrame:
    """Number the scans 1..n in each file."""
    return with_position(df, ["source_file"], order, name)


def assign_batches(
    df: DataFrame,
    keys: list[str],
    order: str = "line_ord",
    time: str = "time",
    seconds: int = BATCH_SECONDS,
    max_records: int = BATCH_MAX_RECORDS,
) -> DataFrame:
    """Batch every ``seconds`` of event time, closed early after ``max_records``.

    Adds ``batch_start`` and ``batch_part``; the count restarts with the bucket.
    """
    bucketed = df.withColumn(
        "batch_start", F.window(F.col(time), f"{seconds} seconds").getField("start")
    )
    placed = with_position(bucketed, [*keys, "batch_start"], order, "_position")
    return placed.withColumn(
        "batch_part", F.floor((F.col("_position") - 1) / max_records).cast("bigint")
    ).drop("_position")


def downsample_bucket(
    df: DataFrame,
    keys: list[str],
    order: str = "line_ord",
    time: str = "time",
    seconds: int = RECORD_GAP_SECONDS,
) -> DataFrame:
    """First record of each key in each fixed time bucket."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(time, order)).alias("_first")
    bucket = F.window(F.col(time), f"{seconds} seconds").getField("start")
    return (
        df.groupBy(*keys, bucket.alias("bucket_start"))
        .agg(first)
        .select(*keys, "bucket_start", "_first.*")
    )
