"""Small helpers of the operators: bounded batches, free names, repeated runs."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.session import remove_dir, scratch_dir

#: Text that a task holds at once, in bytes; a longer text is held alone.
SLICE_BYTES = 8 << 20
#: Rows that one task writes where a table is known to be small.
ROWS_A_TASK = 2000


def slices(batches: Iterable[pa.RecordBatch], *texts: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` bytes of all the text columns, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = [pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in texts]
        ends = np.cumsum(np.sum(lengths, axis=0))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str) -> pa.StringArray:
    """The texts as a fresh array with offsets from 0, null as empty."""
    return pa.concat_arrays([pc.fill_null(batch.column(text), ""), pa.array([], batch.column(text).type)]).cast(pa.string())


def value_bytes(array: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its values."""
    n = len(array)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + n + 1].astype(np.int64)
    if array.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(array.buffers()[2], np.uint8), offsets


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of runs ``start .. start+length-1``, one run after another."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]), dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def give_back() -> None:
    """Hand memory that was freed back to the system; the allocators of Arrow and of the
    C library would keep it for as long as the process lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(step: Callable) -> Callable:
    """``step`` of a ``mapInArrow``, after which the Python worker gives back what the task
    no longer holds: a worker lives on from task to task, beside the heap of its executor,
    and would stay as large as its largest task was."""

    def run(batches):
        yield from step(batches)
        give_back()

    return run


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"_{wanted}"
    while name.lower() in taken:
        name += "_"
    return name


def kept_table(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, and a
    lost executor costs no second run of what is behind. ``rows``: about how many the
    last step handles, where that is known; few are written by few tasks."""
    spark: SparkSession = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, min(rows // ROWS_A_TASK, 1 << 20)))
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def drop_kept(*tables: DataFrame) -> None:
    """Delete tables of :func:`kept_table` whose last reader has written its rows."""
    for kept in tables:
        remove_dir(kept.sparkSession, kept.kept_path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows and bytes, for the session: texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))


def text_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever else the table holds."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def crc32_of(doc_id: str | Column) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary"))
