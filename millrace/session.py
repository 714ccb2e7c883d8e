"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import millrace

SESSION_CONF = {
    # Timestamps are compared and formatted in UTC whatever the host's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState keeps its state in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit the changes of a batch rather than a whole snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_root: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    # Executors get our Python code with the tasks, without an installed package.
    cloudpickle.register_pickle_by_value(millrace)
    return spark


def build_session(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    """Make a session; keyword names use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for checkpoints, replays and read-back tables.

    It lies under ``spark.checkpoint.dir``, which on a cluster names a folder
    that all nodes share. Only a local master may go without that setting.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all nodes")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="millrace-"))
            atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
        root = _local_root[0]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the scratch folder and read again: several uses cost one run."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system its path names; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
