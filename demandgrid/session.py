"""Session settings, and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Wall-clock columns are timestamp_ntz; a UTC session makes every cast between the two kinds the identity.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Open hours of a stream live in state: keep them off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "demandgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session with ``SETTINGS``; ``conf`` keys use ``__`` for ``.`` and win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own; on a cluster other machines could not see it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="demandgrid-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return os.path.join(base, f"demandgrid-{uuid.uuid4().hex}", label)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where a result feeds several branches: a lost executor then re-reads files instead of recomputing the branch,
    and every reader still gets column pruning and pushed filters.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def take_name(spark: SparkSession, fs, hidden, shown) -> bool:
    """Give the complete file ``hidden`` the name ``shown``, for one caller only; False if the name is taken.

    On a local file system that is a hard link, which fails if the name exists; elsewhere a rename that does not replace, as
    on HDFS. A store whose rename replaces silently needs one writer at a time.
    """
    if fs.getScheme() != "file":
        return not fs.exists(shown) and fs.rename(hidden, shown)
    files, paths = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.Paths
    local = lambda p: paths.get(fs.makeQualified(p).toUri().getPath(), spark._sc._gateway.new_array(spark._jvm.java.lang.String, 0))
    try:
        files.createLink(local(shown), local(hidden))
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(hidden, False)
    return True


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file for one caller only; False if it is there. A claim whose owner died stays."""
    jvm = spark._jvm
    shown = jvm.org.apache.hadoop.fs.Path(path)
    hidden = jvm.org.apache.hadoop.fs.Path(shown.getParent(), f"_{uuid.uuid4().hex}")
    fs = shown.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(hidden, False).close()
    return take_name(spark, fs, hidden, shown)
