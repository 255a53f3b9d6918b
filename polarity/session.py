"""Session helpers: a configured local session for tests and benches, and the
checkpoint folder rule.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared file system). Only a local master without that setting gets a fresh
temporary folder; a cluster without it is an error, never a local /tmp.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "polarity",
                  extra: dict | None = None) -> SparkSession:
    """A local session with the settings the library is tuned for."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(HDFS/object store) before running lineage-cutting operators")
    own = tempfile.mkdtemp(prefix="polarity-ckpt-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)  # this process's alone
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers the package, wherever they start: added to the
    application once as a zip file (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="polarity-zip-")  # the driver's, served by Spark
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "polarity.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, names in os.walk(top):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(base, n)
                    z.write(f, os.path.join("polarity", os.path.relpath(f, top)))
    sc.addPyFile(path)


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never a
    machine-local one on a cluster); each call gets its own."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    _scratch.append(f"{root}/polarity-{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def drop_scratch(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete the scratch folders made after the first ``since`` (see
    ``scratch_mark``) and up to ``until``, once nothing reads them any more:
    results that were returned but not yet written still do. Returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    until = len(_scratch) if until is None else until
    done = [i for i in range(since, until) if _scratch[i]]
    for i in done:
        path = jvm.org.apache.hadoop.fs.Path(_scratch[i])
        path.getFileSystem(conf).delete(path, True)
        _scratch[i] = ""  # places stay, so that earlier marks do
    while _scratch and not _scratch[-1]:
        _scratch.pop()
    return len(done)


def scratch_mark() -> int:
    return len(_scratch)


def checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint
    folder and continue from that table.

    One job computes the data (an eager RDD checkpoint of an unpersisted
    plan computes it twice), the copy survives executor loss, and the
    result is an ordinary Parquet scan with pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
