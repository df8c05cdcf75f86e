"""Lines of one large file meet its header in many tasks."""

import pytest
from pyspark.sql import functions as F

from marinelake.sources import tables
from marinelake.sources.tables import cnv_records, csv_records


def _tasks(spark, rows):
    """Tasks that the rows lie in, with a join that cannot broadcast and is not re-planned."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = rows.groupBy("source_file", F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return len({r["task"] for r in found}), sum(r["count"] for r in found)


@pytest.mark.parametrize("records, head", [(csv_records, ["# note", "a,b"]), (cnv_records, ["# name 0 = a: x", "# name 1 = b: y"])])
def test_a_large_file_is_spread(spark, lines, records, head, monkeypatch):
    monkeypatch.setattr(tables, "BLOCK_BITS", 3)
    separator = "," if records is csv_records else " "
    text = [*head, *[f"{i}{separator}{i + 1}" for i in range(400)]]
    rows = records(lines(text).unionByName(lines(text[1:3], source="g")))
    tasks, count = _tasks(spark, rows)
    assert count == 401 and tasks > 4
    got = {(r["source_file"], r["line_ord"]): r["record"] for r in rows.collect()}
    expected = {("f", i + 2): {"a": str(i), "b": str(i + 1)} for i in range(400)}
    small = {("g", 1): {"a": "0", "b": "1"}} if records is csv_records else {("g", 1): {"b": "0"}}
    assert got == expected | small
