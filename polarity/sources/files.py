"""Files of the shared folder: as the driver asks for them through Spark's file
systems, and as tasks read them without a session."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path), the driver's view."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def filesystem(uri: str):
    """(file system, path) of a Hadoop-style path or URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def read_folder(uri: str, columns: list[str]) -> pa.Table | None:
    """The rows of a folder of Parquet files, None if it has none."""
    fs, path = filesystem(uri)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    parts = []
    for f in sorted(f.path for f in found if f.base_name.endswith(".parquet")):
        with fs.open_input_file(f) as source:
            parts.append(pq.ParquetFile(source).read(columns))
    return pa.concat_tables(parts) if parts else None
