"""Compute once, reuse while the inputs are the same.

A cached part counts as present only when its ``_SUCCESS`` marker exists
(written last by the committer), so a crash mid-write never leaves a cache
that later runs would trust. With inputs or parameters given it must also hold
the manifest they have now: every input file's path, size and time of change,
and the parameters. The manifest is taken before the part is built and written
after it, so an input that changes meanwhile makes the part stale.
"""

from __future__ import annotations

import hashlib
import json
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from polarity.sources.files import exists, hadoop_path

MANIFEST = "_MANIFEST"


def is_complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def _files(spark: SparkSession, path: str):
    """(path, size, time of change) of the files under ``path``, which may be
    one file or hold wildcards; no match is an error."""
    fs, p = hadoop_path(spark, path)
    found = fs.globStatus(p)
    if not found:
        raise FileNotFoundError(path)
    for top in found:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            f = files.next()
            yield str(f.getPath()), f.getLen(), f.getModificationTime()


def manifest(spark: SparkSession, inputs: Iterable[str | DataFrame] = (),
             params: dict | None = None) -> str:
    """A line of JSON that names the state of ``inputs`` (paths, or tables
    whose files are taken) and ``params`` (what JSON can hold): the number of
    files, their bytes, and a digest of all."""
    digest, n, size = hashlib.sha256(), 0, 0
    for given in inputs:
        paths = sorted(given.inputFiles()) if isinstance(given, DataFrame) else [given]
        for entry in sorted(e for p in paths for e in _files(spark, p)):
            digest.update((json.dumps(entry) + "\n").encode())
            n, size = n + 1, size + entry[1]
        digest.update(b"\n")  # inputs are told apart
    digest.update(json.dumps(params or {}, sort_keys=True).encode())
    return json.dumps({"files": n, "bytes": size, "sha256": digest.hexdigest()})


def _read(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, line: str) -> None:
    fs, p = hadoop_path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.writeUTF(line)
    finally:
        stream.close()


def materialize_once(spark: SparkSession, build: Callable[[], DataFrame], path: str,
                     inputs: Iterable[str | DataFrame] | None = None,
                     params: dict | None = None) -> DataFrame:
    """Read ``path`` if a complete copy is there; otherwise build, write
    (replacing any partial leftovers) and read back. With ``inputs`` or
    ``params`` a copy of other files or parameters is stale and built again;
    without both any complete copy is trusted."""
    keyed = inputs is not None or params is not None
    now = manifest(spark, inputs or (), params) if keyed else None
    note = f"{path.rstrip('/')}/{MANIFEST}"
    if not is_complete(spark, path) or (keyed and _read(spark, note) != now):
        build().write.mode("overwrite").parquet(path)
        if keyed:
            _write(spark, note, now)
    return spark.read.parquet(path)
