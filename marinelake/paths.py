"""Paths as Spark writes them, for use with Arrow and for comparison."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def arrow_filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow filesystem and inner path; without a scheme the path is a mounted one."""
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; without one it is of the default file system, as for Spark."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def without_scheme(path: Column) -> Column:
    """The path alone, without scheme and authority."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
