"""Micro-batches that write several tables and publish them at once.

Every attempt at a micro-batch writes its tables into folders of its own. One small file
per micro-batch, written last, names the attempt that counts. Readers see the attempts
so named, hence all tables of a micro-batch or none; what a failed attempt left behind is
never seen, and a micro-batch that comes again is known by its file and skipped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.storage import names_below, path_exists, read_small, write_new

_COMMIT = "batch_id BIGINT, attempt STRING"


class Commits:
    """The published micro-batches of one stream into one output folder.

    ``source`` names the stream. It goes with the stream's checkpoint: a stream that is
    begun anew with an empty checkpoint counts from 0 again and needs a new name.
    """

    def __init__(self, spark: SparkSession, out: str, source: str = "stream"):
        self.spark, self.out, self.source = spark, out, source
        self.folder = f"{out}/commits/source={source}"

    def _marker(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id:020d}.json"

    def published(self, batch_id: int) -> bool:
        return path_exists(self.spark, self._marker(batch_id))

    def facts_before(self, batch_id: int) -> dict:
        """What the last published micro-batch before this one left for the next."""
        marker = self._marker(batch_id - 1)
        if batch_id == 0 or not path_exists(self.spark, marker):
            earlier = [n for n in names_below(self.spark, self.folder) if n < f"{batch_id:020d}"]
            if not earlier:
                return {}
            marker = f"{self.folder}/{earlier[-1]}"
        return json.loads(read_small(self.spark, marker))["facts"]

    def write(self, batch_id: int, tables: dict[str, DataFrame], facts: dict | None = None) -> bool:
        """Write the tables and publish them; False if the micro-batch was published before."""
        if self.published(batch_id):
            return False
        return self.publish(batch_id, self.write_tables(batch_id, tables), facts)

    def write_tables(self, batch_id: int, tables: dict[str, DataFrame]) -> str:
        """Write the tables under a new attempt, which nobody sees yet."""
        attempt = f"a-{uuid.uuid4().hex}"
        for name, rows in tables.items():
            rows.write.parquet(f"{self.out}/{name}/source={self.source}/batch_id={batch_id}/attempt={attempt}")
        return attempt

    def publish(self, batch_id: int, attempt: str, facts: dict | None = None) -> bool:
        line = {"batch_id": batch_id, "attempt": attempt, "facts": facts or {}}
        return write_new(self.spark, self._marker(batch_id), json.dumps(line))


def published_table(spark: SparkSession, out: str, name: str, source: str | None = None) -> DataFrame:
    """Rows of all published micro-batches, with ``source`` and ``batch_id``.

    The attempts that count are a small table, joined on the partition columns, so that
    folders of other attempts are not read. A stream that has published nothing yet has
    no rows, of the columns that its unpublished attempts have."""
    commits = spark.read.schema(_COMMIT + ", source STRING").json(f"{out}/commits")
    rows = spark.read.option("mergeSchema", "true").parquet(f"{out}/{name}")
    if source is not None:
        rows, commits = (t.where(F.col("source").cast("string") == source) for t in (rows, commits))
    keys = {"source": F.col("source").cast("string"), "batch_id": F.col("batch_id").cast("bigint")}
    return rows.withColumns(keys).join(commits.withColumns(keys), ["source", "batch_id", "attempt"], "left_semi").drop("attempt")
