"""Lines before the first header of their stream wait for it, however many they are."""

from pyspark.sql import functions as F

from marinelake.plans.stream_ingest import csv_stream
from marinelake.plans.stream_queries import MESSAGE
from marinelake.streaming.lines import broker_lines
from marinelake.streaming.sequences import HeaderInForce
from tests.test_live import Store
from tests.test_pieces import SIZE, given, small_memory  # noqa: F401


class Entries(dict):
    def updateValue(self, key, value):
        assert key not in self
        self[key] = value

    getValue, removeKey = dict.__getitem__, dict.__delitem__


class Stores(Store):
    """Map states too."""

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Entries())


def lines(start, stop, header=None):
    return [{"line_ord": i, "value": "h" if i == header else f"v{i}", "state_order": i, "state_mark": i == header} for i in range(start, stop)]


def test_all_lines_wait_and_come_back_chunk_by_chunk():
    processor, store = HeaderInForce("value", ["line_ord", "value"]), Stores()
    processor.init(store)
    assert given(processor, lines(0, 120)) == [] and given(processor, lines(120, 1000), 1) == []
    assert len(store.states["waiting"]) >= 1000 // SIZE and not store.states["held"].exists()
    # None of the parts given is larger than a piece.
    rows = given(processor, lines(1000, 1100, 1050), 2)
    assert sorted((r["line_ord"], r["value"], r["header"]) for r in rows) == [(i, f"v{i}", "h") for i in range(1100) if i != 1050]
    assert not store.states["waiting"] and [r["header"] for r in given(processor, lines(1100, 1102))] == ["h", "h"]


def test_lines_that_began_to_wait_with_a_limit_go_on_without_one():
    store = Stores()
    bounded, free = HeaderInForce("value", ["line_ord", "value"], 100), HeaderInForce("value", ["line_ord", "value"])
    bounded.init(store)
    assert given(bounded, lines(0, 90)) == []
    free.init(store)
    assert given(free, lines(90, 200)) == []
    rows = given(free, lines(200, 210, 205))
    assert sorted((r["line_ord"], r["header"]) for r in rows) == [(i, "h") for i in range(210) if i != 205]
    assert not store.states["waiting"] and not store.states["held"].exists()


def test_csv_stream_rejects_no_line_whose_header_comes_late(spark, tmp_path):
    folder, n = f"{tmp_path}/in", 120_000

    def run(turn, messages):
        messages.select("key", "offset", F.col("line").cast("binary").alias("value"), F.timestamp_seconds(F.lit(0)).alias("timestamp")).write.parquet(f"{folder}/turn={turn}")
        stream = csv_stream(broker_lines(spark.readStream.schema(MESSAGE).parquet(folder)))
        stream.select("source_file", "line_ord", "reject_reason", "latitude").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
            "checkpointLocation", f"{tmp_path}/state"
        ).trigger(availableNow=True).start().awaitTermination()

    stamped = F.concat(F.lit("2024-01-01T00:00:00Z,"), (F.col("id") % 90).cast("string"))
    data = spark.range(n).select(F.lit("a").alias("key"), F.col("id").alias("offset"), stamped.alias("line"))
    run(0, data.where("offset % 2 = 0"))
    run(1, data.where("offset % 2 = 1"))
    assert spark.read.schema("line_ord bigint").parquet(f"{tmp_path}/out").count() == 0
    run(2, spark.createDataFrame([("a", n, "time,latitude"), ("a", n + 1, "2024-01-01T00:00:01Z,7")], "key string, offset bigint, line string"))
    rows = spark.read.parquet(f"{tmp_path}/out").cache()
    assert rows.where("reject_reason is not null").count() == 0
    assert rows.count() == rows.select("line_ord").distinct().count() == n + 1
    assert rows.where("line_ord < 120000 and latitude <> line_ord % 90 or latitude is null").count() == 0
