"""File listings and parquet footers as DataFrames."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import ship_package

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
FOOTER_SCHEMA = "dataset string, path string, name string, n_rows bigint, cols array<string>, error string"


def list_files(
    spark: SparkSession, folders: str | Sequence[str], glob: str = "*.parquet", recursive: bool = True
) -> DataFrame:
    """One row per file: ``dataset, path, name, top_level``; no file is opened.

    ``dataset`` is the folder as given, so one listing serves many datasets. The names come from
    the file index Spark makes of a folder; a scan of it would leave out files of zero bytes, which
    an audit must see.
    """
    folders = [folders] if isinstance(folders, str) else list(folders)
    rows = [(folder, *entry) for folder in folders for entry in _entries(spark, folder, glob, recursive)]
    return spark.createDataFrame(rows, "dataset string, path string, name string, top_level boolean")


def _entries(spark: SparkSession, folder: str, glob: str, recursive: bool) -> Iterator[tuple[str, str, bool]]:
    root = re.sub(SCHEME, "", folder) if re.match(SCHEME, folder) else os.path.abspath(folder)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    for path in map(unquote, files.inputFiles()):
        parent, name = re.sub(SCHEME, "", path).rsplit("/", 1)
        yield path, name, parent == root.rstrip("/")


def read_footers(files: DataFrame) -> DataFrame:
    """Column names and row count of every listed file, from its footer, read in the tasks.

    A file that is no whole parquet file gives a row with ``error`` set, an empty table a row with 0 rows. Any
    other failure (no permission, a file that went away, a store that cannot be reached) says nothing about the
    data and fails the job. Object stores are opened with the credentials of the session; of stores that the
    workers cannot open themselves Spark reads the files.
    """
    ship_package(files.sparkSession)
    listed = files.select("dataset", "path", "name")
    own = F.lower(F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)).isin("", *OPENED)
    options = store_options(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pairloom.sources.files import footers_of

        return footers_of(batches, options)

    near = listed.where(own).mapInArrow(run, FOOTER_SCHEMA)
    far = listed.where(~own)
    paths = [r["path"] for r in far.select("path").limit(1).collect()]
    return near.unionByName(_far_footers(far)) if paths else near


#: Schemes that the workers open themselves.
OPENED = ("file", "s3", "s3a", "s3n", "gs", "hdfs")
_STORE_KEYS = {
    "fs.s3a.access.key": "access_key", "fs.s3a.secret.key": "secret_key", "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override", "fs.s3a.endpoint.region": "region",
}


def store_options(spark: SparkSession) -> dict[str, str]:
    """What the session knows of the S3 store, by the names of the workers' library."""
    conf = spark._jsc.hadoopConfiguration()
    found = {ours: conf.get(theirs) for theirs, ours in _STORE_KEYS.items()}
    return {name: value for name, value in found.items() if value}


def _far_footers(files: DataFrame) -> DataFrame:
    """Footers of files that only Spark can open: it reads them whole, each folder as one source."""
    spark = files.sparkSession
    folders = [r[0] for r in files.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().toLocalIterator()]
    content = spark.read.format("binaryFile").load(folders).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pairloom.sources.files import footers_in

        return footers_in(batches)

    slashes = F.regexp_replace("path", "^file:/+", "file:/")  # written in two ways
    files, content = files.withColumn("_place", slashes), content.withColumn("_place", slashes).drop("path")
    return files.join(content, "_place").select("dataset", "path", "name", "content").mapInArrow(run, FOOTER_SCHEMA)


def footers_of(batches: Iterator[pa.RecordBatch], options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_footer(*_opened(path, options)) for path in batch.column("path").to_pylist()]
        yield _rows(batch, found)


def footers_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_footer(None, pa.BufferReader(c.as_buffer())) for c in batch.column("content")]
        yield _rows(batch, found)


def _rows(batch: pa.RecordBatch, found: list[tuple[int | None, list[str] | None, str | None]]) -> pa.RecordBatch:
    rows, cols, errors = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("dataset"),
            batch.column("path"),
            batch.column("name"),
            pa.array(rows, pa.int64()),
            pa.array(cols, pa.list_(pa.string())),
            pa.array(errors, pa.string()),
        ],
        names=["dataset", "path", "name", "n_rows", "cols", "error"],
    )


def _opened(path: str, options: dict[str, str]) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), re.sub(SCHEME, "", path)
    if re.match("^s3[an]?:", path):
        return fs.S3FileSystem(**options), re.sub("^s3[an]?://", "", path)
    return fs.FileSystem.from_uri(path)


def _footer(system: fs.FileSystem | None, file: str | pa.NativeFile) -> tuple[int | None, list[str] | None, str | None]:
    handle = file if system is None else system.open_input_file(file)  # what fails here is no finding
    try:
        footer = pq.ParquetFile(handle)
        return footer.metadata.num_rows, footer.schema_arrow.names, None
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
        return None, None, f"{type(error).__name__}: {error}"
    except OSError as error:
        if "thrift" not in str(error):  # what the library says of footers that end early or make no sense
            raise
        return None, None, f"{type(error).__name__}: {error}"
    finally:
        handle.close()


def write_shards(df: DataFrame, folder: str, n: int) -> None:
    """``df`` as ``n`` files ``train-<i>-of-<n>.parquet`` of about equal size, in a new folder.

    Spark writes the files; when all are there they get their names in the same file system.
    """
    spark = df.sparkSession
    df.repartition(n).write.parquet(f"{folder}/_parts")
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = jvm.org.apache.hadoop.fs.Path(root, "_parts")
    names = sorted(f.getPath().getName() for f in system.listStatus(parts) if f.getPath().getName().startswith("part-"))
    schema = df.schema
    for name in names:
        number = int(name.split("-")[1])
        system.rename(jvm.org.apache.hadoop.fs.Path(parts, name), jvm.org.apache.hadoop.fs.Path(root, shard_name(number, n)))
    missing = set(range(n)) - {int(name.split("-")[1]) for name in names}
    if missing:  # a partition without rows has no file
        empty = jvm.org.apache.hadoop.fs.Path(root, "_empty")
        for number in sorted(missing):
            spark.createDataFrame([], schema).coalesce(1).write.parquet(empty.toString())
            (file,) = [f.getPath() for f in system.listStatus(empty) if f.getPath().getName().startswith("part-")]
            system.rename(file, jvm.org.apache.hadoop.fs.Path(root, shard_name(number, n)))
            system.delete(empty, True)
    system.delete(parts, True)


def shard_name(number: int, n: int) -> str:
    return f"train-{number:05d}-of-{n:05d}.parquet"
