"""De-duplication, position filtering and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Families with many rows per timestamp, exempt from keep-first.
GRID_FAMILIES = ["adcp", "ad2cp"]


def dedupe_first(
    df: DataFrame,
    keys: list[str],
    order: str = "line_ord",
    merge: bool = False,
) -> DataFrame:
    """Keep the first row of each key, by aggregation.

    ``min_by`` combines copies before the shuffle, so a key with a third of all
    rows reaches its reducer as one row per map task. With ``merge`` every column
    takes its first non-null value instead, which keeps the fields of different
    sentences that share a timestamp.
    """
    rest = [c for c in df.columns if c not in keys]
    if merge:
        firsts = [
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest
        ]
        return df.groupBy(*keys).agg(*firsts).select(*df.columns)
    first = F.min_by(F.struct(*rest), order).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def dedupe_records(
    df: DataFrame, family: str = "file_type", order: str = "line_ord", merge: bool = False
) -> DataFrame:
    """Keep-first per file and time in one pass.

    Rows of gridded families and rows without a time are told apart by ``order``
    and so all stay; ``order`` is unique among them in a file.
    """
    exempt = F.coalesce(F.col(family).isin(GRID_FAMILIES), F.lit(False)) | F.col("time").isNull()
    marked = df.withColumn("_own", F.when(exempt, F.col(order)))
    return dedupe_first(marked, ["source_file", "time", "_own"], order, merge).drop("_own")


def has_position() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def valid_positions(df: DataFrame, source: str = "source_file") -> DataFrame:
    """Rows that are written: positioned ones, or all rows of a file without any.

    Positioned rows pass through without a shuffle; only the others are checked
    against the files that have a position.
    """
    located = df.where(has_position())
    sources = located.select(source).distinct()
    unlocated = df.where(~has_position()).join(sources, source, "left_anti")
    return located.unionByName(unlocated.select(*df.columns))


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason, and the rejected rows with it."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def concat_members(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames over the union of their columns."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def sorted_track(df: DataFrame, source: str = "source_file", order: str = "line_ord") -> DataFrame:
    """Rows of each file by time, ties in file order.

    Range partitioning gives a total order and spreads a hot file over tasks.
    """
    keys = [source, "time", order]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
