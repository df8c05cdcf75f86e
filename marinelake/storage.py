"""Small files in whatever file system Spark uses, handled by the driver."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that appears whole or not at all; an existing one stays and
    gives False."""
    files, place = _place(spark, path)
    if files.exists(place):
        return False
    folder, name = os.path.split(path)
    draft = _place(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")[1]
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        return False
    return True


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a folder, in order; drafts are left out."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(n for n in names if not n.startswith(("_", ".")))
