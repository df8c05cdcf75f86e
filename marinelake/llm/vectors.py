"""Vectors as bytes, and what counts as a vector."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def number_type(df: DataFrame, embedding: str) -> str:
    """The numpy type that holds the components exactly."""
    kind = df.schema[embedding].dataType
    return "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


#: Lengths of vectors whose index is fitted, at most, the commonest ones.
FITTED_LENGTHS = 8


def common_lengths(df: DataFrame, vector: str) -> dict[int, int]:
    """The commonest numbers of components (``FITTED_LENGTHS`` at most) and the rows that have them."""
    counts = df.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return {r["d"]: r["n"] for r in counts.orderBy(F.desc("n"), F.desc("d")).limit(FITTED_LENGTHS).collect()}


def by_length(batch: pa.RecordBatch, vector: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch in parts of one length of vector each, with that length."""
    lengths = pc.list_value_length(batch.column(vector))
    for d in pc.unique(lengths).to_pylist():
        yield d, batch.filter(pc.equal(lengths, d))


def matrix(column, kind: str = "<f8") -> np.ndarray:
    """Rows of an Arrow list column without nulls as a matrix."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def unpacked(values: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(np.float64)


def drawn(df: DataFrame, vector: str, total: int, most: int, kind: str = "<f8") -> np.ndarray:
    """About ``most`` rows, evenly over the table by a hash of the vector: a bounded sample."""
    if total <= most:
        taken = df.select(vector)
    else:
        taken = df.where(F.pmod(F.xxhash64(vector, F.lit(11)), F.lit(1 << 30)) < int(most / total * (1 << 30))).select(vector)
    rows = taken.toArrow().column(0)
    found = matrix(rows, kind) if len(rows) else np.zeros((0, 1))
    return found[np.lexsort(found.T[::-1])]  # in one order, whatever the partitions
