"""Session settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    # Instants are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A header that names a column twice keeps the last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: measured broadcasts, skew splits, partition coalescing.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Generated methods above the JIT compiler's limit would run interpreted;
    # beyond it Spark compiles the stage in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with the deployment."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local session may go without:
    there one machine runs all tasks, and a folder of its own is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="marinelake-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
