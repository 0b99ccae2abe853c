"""Session helpers: a tuned local session for tests/bench and the shared
folder used for lineage cuts and round-trip files.

The library never builds a session on its own inside operators; the caller
owns the session. ``shared_dir`` reads ``spark.checkpoint.dir`` (the cluster's
shared, fault-tolerant folder). Only a ``local[...]`` master, where one machine
is the whole cluster, may leave it unset and gets a private folder; any other
master without it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "footfall",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A local session configured the way the engine expects a cluster to be."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session, set only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="footfall-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique (not yet existing) path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/footfall/{name}-{uuid.uuid4().hex[:12]}"


class HadoopPath:
    """A path with the Hadoop file system it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.path = self._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(self._conf)

    def read(self) -> str:
        stream = self.fs.open(self.path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, text: str) -> None:
        """A new file; the folders above it are made."""
        stream = self.fs.create(self.path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_if_free(self, target: str) -> bool:
        """Rename in one step, unless ``target`` exists."""
        fs = self._jvm.org.apache.hadoop.fs
        rename = getattr(fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.valueOf("NONE")
        there = self.fs.makeQualified(fs.Path(target))
        try:
            fs.FileContext.getFileContext(there.toUri(), self._conf).rename(self.fs.makeQualified(self.path), there, options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True


def hadoop_path(spark: SparkSession, path: str) -> HadoopPath:
    return HadoopPath(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged rows through the Hadoop file system it is in."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
