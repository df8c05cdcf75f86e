"""Token ids in binary shards: one wavelet matrix per file.

Bit-planes from the highest bit down, each followed by a stable partition of the
ids by that bit; counts of ones per 512 bits make rank and select cheap. A file
answers token access, counting and occurrence lookup without being decoded whole.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marinelake.llm.common import slices, text_rows, texts_of
from marinelake.llm.registry import query, table
from marinelake.llm.tokens import kept_byte_level, public_tokenizer
from marinelake.paths import arrow_filesystem
from marinelake.session import scratch_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Text bytes per range of documents, and ids per file: what a task holds.
RANGE_BYTES = 24 << 20
FILE_IDS = 6_000_000
_BLOCK = 512
_MAGIC = b"WVLT0001"


class WaveletMatrix:
    """Access, rank, select and decoding over packed bit-planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ones: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ones = n, planes, zeros, ones

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        x = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros, ones = [], [], []
        for k in range(width - 1, -1, -1):
            bit = x & x.dtype.type(1 << k) != 0
            packed = np.packbits(bit)
            planes.append(packed)
            left = np.flatnonzero(~bit)  # much faster than a mask as index
            zeros.append(len(left))
            x = np.concatenate([x.take(left), x.take(np.flatnonzero(bit))])
            ones.append(cls._blocks(packed))
        return cls(len(ids), planes, zeros, ones)

    @staticmethod
    def _blocks(packed: np.ndarray) -> np.ndarray:
        """Ones before each block of 512 bits."""
        size = _BLOCK // 8
        filled = np.zeros(-(-len(packed) // size) * size, np.uint8)
        filled[: len(packed)] = packed
        per_block = np.bitwise_count(filled.reshape(-1, size)).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    def _bits(self, plane: int, lo: int, hi: int) -> np.ndarray:
        return np.unpackbits(self.planes[plane][lo // 8 : -(-hi // 8)])[lo % 8 :][: hi - lo]

    def _ones_before(self, plane: int, i: int) -> int:
        block = i // _BLOCK
        return int(self.ones[plane][block]) + int(self._bits(plane, block * _BLOCK, i).sum())

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for p in range(len(self.planes)):
            ones = self._ones_before(p, i)
            bit = int(self._bits(p, i, i + 1)[0])
            i = self.zeros[p] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, hi, width = 0, i, len(self.planes)
        if token >> width:
            return 0, 0
        for p in range(width):
            a, b = self._ones_before(p, lo), self._ones_before(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if token >> (width - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before position ``i``."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """The position of occurrence ``j`` of ``token``, counted from 0."""
        lo, hi = self._range(token, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        at = lo + j
        for p in range(len(self.planes) - 1, -1, -1):
            bit = int(at >= self.zeros[p])
            wanted = at - self.zeros[p] if bit else at
            ones = self.ones[p].astype(np.int64)
            before = ones if bit else np.minimum(np.arange(len(ones)) * _BLOCK, self.n) - ones
            block = int(np.searchsorted(before, wanted, "right")) - 1
            bits = self._bits(p, block * _BLOCK, min(self.n, (block + 1) * _BLOCK))
            at = block * _BLOCK + int(np.flatnonzero(bits == bit)[wanted - int(before[block])])
        return at

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of ``token``, ascending."""
        lo, hi = self._range(token, self.n)
        at = np.arange(lo, hi)
        for p in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bit = int(at[0] >= self.zeros[p])  # all of them lie on one side
            at = np.flatnonzero(self._bits(p, 0, self.n) == bit)[at - self.zeros[p] * bit]
        return at

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        width = len(self.planes)
        x = np.zeros(self.n, np.uint16 if width <= 16 else np.uint32)
        for p in range(width - 1, -1, -1):
            bit = self._bits(p, 0, self.n).astype(bool)
            before = np.empty_like(x)
            before[np.flatnonzero(~bit)] = x[: self.zeros[p]]
            before[np.flatnonzero(bit)] = x[self.zeros[p] :] | x.dtype.type(1 << (width - 1 - p))
            x = before
        return x.astype(np.uint32)

    def to_bytes(self, doc_ids: list, lengths: np.ndarray) -> bytes:
        """The file: a line of JSON with sizes, then planes, counts and documents, compressed."""
        import zstandard

        known = np.array([d is not None for d in doc_ids], np.uint8)
        parts = [p.tobytes() for p in self.planes] + [o.tobytes() for o in self.ones]
        parts += [np.array([d or 0 for d in doc_ids], np.int64).tobytes(), known.tobytes(), lengths.astype(np.int64).tobytes()]
        head = json.dumps({"n": self.n, "zeros": self.zeros, "docs": len(doc_ids)}).encode() + b"\n"
        return _MAGIC + zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
        import zstandard

        if data[:8] != _MAGIC:
            raise ValueError("not a shard of token ids")
        body = zstandard.ZstdDecompressor().decompress(data[8:])
        at = body.index(b"\n") + 1
        head = json.loads(body[:at])
        n, docs, width = head["n"], head["docs"], len(head["zeros"])

        def take(kind, count):
            nonlocal at
            part = np.frombuffer(body, kind, count, at)
            at += part.nbytes
            return part

        planes = [take(np.uint8, -(-n // 8)) for _ in range(width)]
        ones = [take(np.uint32, -(-(-(-n // 8)) // (_BLOCK // 8)) + 1) for _ in range(width)]
        ids, known, lengths = take(np.int64, docs), take(np.uint8, docs), take(np.int64, docs)
        return cls(n, planes, head["zeros"], ones), [int(i) if k else None for i, k in zip(ids, known)], lengths


def _with_end(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, offsets[1:], END_ID), np.diff(offsets) + 1


def write_shards(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents in ascending id order; returns the manifest.

    Null ids come first, rows of one id in order of a hash of their text; a null
    text has only the end id. Ranges are cut by id and that hash, so a repeated id
    is not one task. Every attempt of a task writes files of its own; only those of
    the attempt that succeeded are in the manifest (``part, k, file, n_docs,
    n_tokens``), which is a table written by Spark. An empty table gives no file."""
    spark = docs.sparkSession
    rows = text_rows(docs, doc_id, text).withColumn("h", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    ranges = max(1, -(-total // RANGE_BYTES))

    def write(batches):
        filesystem, folder = arrow_filesystem(path)
        filesystem.create_dir(folder, recursive=True)
        encoder = kept_byte_level(public_tokenizer(tokenizer))
        part, held, names, lengths, k = TaskContext.get().partitionId(), [], [], [], 0

        def flush():
            nonlocal held, names, lengths, k
            file = f"ids-{part:06d}-{k:04d}-{uuid.uuid4().hex}.wvlt"
            all_ids, all_lengths = np.concatenate(held), np.concatenate(lengths)
            data = WaveletMatrix.build(all_ids).to_bytes(names, all_lengths)
            with filesystem.open_output_stream(os.path.join(folder, file)) as out:
                out.write(data)
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "k": k, "file": file, "n_docs": len(names), "n_tokens": len(all_ids)}],
                pa.schema([("part", pa.int32()), ("k", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )
            held, names, lengths, k = [], [], [], k + 1
            return row

        for batch in slices(batches, "text"):
            ids, n = _with_end(*encoder.encode(texts_of(batch, "text")))
            held.append(ids.astype(np.uint32))
            lengths.append(n)
            names.extend(batch.column("doc_id").to_pylist())
            if sum(map(len, held)) >= FILE_IDS:
                yield flush()
        if names:
            yield flush()

    written = (
        rows.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "h")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text")
        .select("doc_id", "text")
        .mapInArrow(write, "part int, k int, file string, n_docs bigint, n_tokens bigint")
    )
    manifest = os.path.join(path, "manifest")
    written.write.parquet(manifest)
    return spark.read.parquet(manifest)


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start`` of each file: the ids of all files before it, by sums of blocks of parts."""
    block = F.floor(F.col("part") / 512)
    inside = Window.partitionBy("block").orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    sums = manifest.groupBy(block.alias("block")).agg(F.sum("n_tokens").alias("block_tokens"))
    before = sums.withColumn(
        "block_start",
        F.coalesce(F.sum("block_tokens").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    return (
        manifest.withColumn("block", block)
        .withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before.select("block", "block_start"), "block")
        .select("part", "k", "file", "n_docs", "n_tokens", (F.col("block_start") + F.col("inside")).alias("start"))
    )


def _read(filesystem, folder, file):
    with filesystem.open_input_stream(os.path.join(folder, file)) as stream:
        return WaveletMatrix.from_bytes(stream.read())


def read_shards(manifest: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    files = max(1, manifest.count())

    def read(batches):
        filesystem, folder = arrow_filesystem(path)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix, names, lengths = _read(filesystem, folder, file)
                ids = memoryview(matrix.decode().astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                columns = [pa.array(names, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (
        with_starts(manifest)
        .repartition(files)
        .mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def find_tokens(manifest: DataFrame, path: str, tokens: list[int]) -> DataFrame:
    """``token, position`` of every occurrence of a few ids in the whole corpus, by rank and select."""
    wanted = [int(t) for t in tokens]

    def find(batches):
        filesystem, folder = arrow_filesystem(path)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix, _, _ = _read(filesystem, folder, file)
                for token in wanted:
                    at = matrix.occurrences(token)
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), token)), pa.array(at + start)], ["token", "position"])

    return with_starts(manifest).repartition(max(1, manifest.count())).mapInArrow(find, "token bigint, position bigint")


@query("op7_token_ids")
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    return read_shards(write_shards(table(spark, sf_dir, "documents"), path), path)


__all__ = ["WaveletMatrix", "find_tokens", "read_shards", "with_starts", "write_shards"]
