"""GeoParquet: a point geometry column and the ``geo`` footer Spark cannot write.

The rows are partitioned and shuffled by Spark; each task streams its Arrow batches,
with the geometry made from them, into files. A single folder gets the files of the
successful attempts by renaming. A table of runs is written in place: one small file
per run, written last, names the files that count, and :func:`read_committed` reads
those, so that neither a failed attempt nor a failed run is seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from marinelake.operators.quality import valid_positions
from marinelake.paths import arrow_filesystem, qualified

FORMAT = "marinelake-geoparquet"

# Fixed values of the two published formats.
GEOPARQUET_VERSION = "1.0.0"
WKB_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
#: The folder of a null or empty value.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
CRS_NAME, CRS_AUTHORITY, CRS_CODE = "WGS 84", "EPSG", 4326


def point_wkb(batch: pa.RecordBatch) -> pa.Array:
    """Little-endian WKB of each row's point, null without both coordinates."""
    x, y = (batch.column(c).cast(pa.float64()) for c in ("longitude", "latitude"))
    points = np.empty(batch.num_rows, dtype=WKB_POINT)
    points["order"], points["kind"] = 1, 1
    points["x"], points["y"] = (c.to_numpy(zero_copy_only=False) for c in (x, y))
    size = pa.binary(WKB_POINT.itemsize)
    wkb = pa.Array.from_buffers(size, batch.num_rows, [None, pa.py_buffer(points.tobytes())])
    known = pc.and_(pc.is_valid(x), pc.is_valid(y))
    return pc.if_else(known, wkb.cast(pa.binary()), pa.scalar(None, pa.binary()))


def geo_footer(bbox: list[float] | None) -> bytes:
    """The ``geo`` metadata value of one file."""
    column = {
        "encoding": "WKB",
        "geometry_types": ["Point"],
        "crs": {
            "type": "GeographicCRS",
            "name": CRS_NAME,
            "id": {"authority": CRS_AUTHORITY, "code": CRS_CODE},
        },
    }
    if bbox:
        column["bbox"] = bbox
    return json.dumps(
        {
            "version": GEOPARQUET_VERSION,
            "primary_column": "geometry",
            "columns": {"geometry": column},
        }
    ).encode()


@dataclass
class _Written(WriterCommitMessage):
    """Files of a task: path below the table, rows and bounding box (null without positions)."""

    files: list[dict]


class _File:
    """One open file with its bounding box."""

    def __init__(self, filesystem: fs.FileSystem, base: str, path: str, schema: pa.Schema):
        filesystem.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
        self.path, self.rows, self.bounds = path, 0, []
        self.writer = pq.ParquetWriter(f"{base}/{path}", schema, filesystem=filesystem)

    def add(self, batch: pa.RecordBatch) -> None:
        self.writer.write_batch(batch)
        self.rows += batch.num_rows
        bounds = _bounds(batch)
        if bounds:
            known = np.array([*self.bounds, bounds])
            self.bounds = [[*known[:, :2].min(axis=0).tolist(), *known[:, 2:].max(axis=0).tolist()]]

    def close(self) -> dict:
        bbox = self.bounds[0] if self.bounds else None
        self.writer.add_key_value_metadata({"geo": geo_footer(bbox).decode()})
        self.writer.close()
        return {"file": self.path, "rows": self.rows, "bbox": bbox}


def _placed(batch: pa.RecordBatch, partitions: list[str]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Runs of rows of one partition folder, without the columns that name it."""
    others = [c for c in batch.schema.names if c not in partitions]
    ends = {batch.num_rows}
    for c in partitions:
        ends.update(pc.run_end_encode(batch.column(c)).run_ends.to_pylist())
    start = 0
    for end in sorted(ends):
        part = batch.slice(start, end - start)
        values = [(c, part.column(c)[0].as_py()) for c in partitions]
        folder = "".join(f"{c}={DEFAULT_PARTITION if v is None or v == '' else quote(str(v), safe='')}/" for c, v in values)
        yield folder, part.select(others)
        start = end


class _Writer(DataSourceArrowWriter):
    """With a ``manifest`` files get their final names at once and the commit is one file."""

    def __init__(self, path: str, overwrite: bool, partitions: list[str], manifest: str | None, run: str):
        self.path, self.overwrite = path, overwrite
        self.partitions, self.manifest, self.run = partitions, manifest, run
        self.job = uuid.uuid4().hex
        self.temporary = "" if manifest else f"_temporary-{self.job}/"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, base = arrow_filesystem(self.path)
        files, current, at = [], None, None
        for whole in iterator:
            if not whole.num_rows:
                continue
            for folder, batch in _placed(whole, self.partitions):
                batch = batch.append_column("geometry", point_wkb(batch))
                if current is None or folder != at:
                    if current is not None:
                        files.append(current.close())
                    name = f"{self.temporary}{folder}part-{self.job}-{uuid.uuid4().hex}.parquet"
                    current, at = _File(filesystem, base, name, batch.schema), folder
                current.add(batch)
        if current is not None:
            files.append(current.close())
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, base = arrow_filesystem(self.path)
        files = [f for message in messages if message is not None for f in message.files]
        if self.manifest:
            self._name(files)
            self._clean(filesystem, base, files)
            return
        filesystem.create_dir(base, recursive=True)
        before = [
            f.path
            for f in filesystem.get_file_info(fs.FileSelector(base))
            if f.is_file and f.path.endswith(".parquet")
        ]
        for f in files:
            filesystem.move(f"{base}/{f['file']}", f"{base}/{f['file'].removeprefix(self.temporary)}")
        if self.overwrite:
            for path in before:
                filesystem.delete_file(path)
        self._clean(filesystem, base, files)

    def _name(self, files: list[dict]) -> None:
        """The list of a run's files, complete or not there: it gets its name when written."""
        filesystem, folder = arrow_filesystem(self.manifest)
        filesystem.create_dir(folder, recursive=True)
        with filesystem.open_output_stream(f"{folder}/_{self.job}") as out:
            out.write("".join(json.dumps(f) + "\n" for f in files).encode())
        filesystem.move(f"{folder}/_{self.job}", f"{folder}/{self.run}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, base = arrow_filesystem(self.path)
        files = [f for message in messages if message is not None for f in message.files]
        for f in files if self.manifest else []:
            filesystem.delete_file(f"{base}/{f['file']}")
        self._clean(filesystem, base, [])

    def _clean(self, filesystem: fs.FileSystem, base: str, files: list[dict]) -> None:
        """Remove what attempts that do not count have left beside these files."""
        if not self.manifest:
            temporary = f"{base}/{self.temporary.rstrip('/')}"
            if filesystem.get_file_info(temporary).type == fs.FileType.Directory:
                filesystem.delete_dir(temporary)
            return
        counted = {f"{base}/{f['file']}" for f in files}
        for folder in {path.rpartition("/")[0] for path in counted}:
            for f in filesystem.get_file_info(fs.FileSelector(folder)):
                if f.is_file and f.base_name.startswith(f"part-{self.job}-") and f.path not in counted:
                    filesystem.delete_file(f.path)


def _bounds(batch: pa.RecordBatch) -> list[float] | None:
    """``west, south, east, north`` of a batch."""
    x, y = batch.column("longitude"), batch.column("latitude")
    sides = [pc.min(x), pc.min(y), pc.max(x), pc.max(y)]
    values = [side.as_py() for side in sides]
    return None if any(v is None for v in values) else values


class GeoParquetSource(DataSource):
    """Write-only source; the files read back as plain Parquet."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        named = [c for c in self.options.get("partitions", "").split(",") if c]
        return _Writer(self.options["path"], overwrite, named, self.options.get("manifest"), self.options.get("run", ""))


def write_geoparquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the rows of ``df`` with their geometry; a file without any position is
    written whole, with null geometry."""
    _write(valid_positions(df), mode, path=path)


def write_committed(df: DataFrame, path: str, manifest: str, run: str, partitions: list[str]) -> None:
    """Add the rows of ``df``, sorted by ``partitions``, to a table of runs: files in
    folders by those columns, named by ``run.json`` below ``manifest``."""
    _write(df, "append", path=path, manifest=manifest, run=run, partitions=",".join(partitions))


def _write(df: DataFrame, mode: str, **options: str) -> None:
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(GeoParquetSource)
    places = {k: qualified(spark, v) if k in ("path", "manifest") else v for k, v in options.items()}
    df.write.format(FORMAT).mode(mode).options(**places).save()


def committed_files(spark: SparkSession, manifest: str) -> DataFrame:
    """``file, rows, bbox, run`` of the files that count; ``bbox`` is west, south, east, north."""
    named = spark.read.schema("file STRING, rows BIGINT, bbox ARRAY<DOUBLE>").json(manifest)
    return named.withColumn("run", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))


def read_committed(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """The rows of a table of runs. The driver holds its list of files, as for any table."""
    files = [f"{path}/{r['file']}" for r in committed_files(spark, manifest).select("file").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], "source_file STRING, time TIMESTAMP, latitude DOUBLE, longitude DOUBLE, geometry BINARY, run STRING")
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*files)
