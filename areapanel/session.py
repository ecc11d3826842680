"""Session construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_session`` only fills
in settings that are still unset, so cluster-level values always win.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: months are DATE in UTC, ANSI arithmetic stays on,
# and AQE re-plans shuffles (partition coalescing and skew-join splitting).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "areapanel",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one (tests, local runs).

    An existing session (cluster launch) is returned as it is: its settings win.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only on a local master, where every task sees the
    driver's disk, is a private folder made when the setting is absent; on a
    cluster that would be a folder the executors cannot share, so it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not is_local_master(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="areapanel-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df):
    """``df.checkpoint()`` into the shared checkpoint folder (registered first if this
    session has none yet). Cuts lineage so a lost executor recomputes from the
    written data; never a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, removed when the
    application ends.

    Used for intermediate tables that cut lineage or that a step renders and
    reads back; never a machine-local folder.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/areapanel-scratch/{name}-{uuid.uuid4().hex[:12]}"
    target, fs = hadoop_path(spark, path)
    fs.deleteOnExit(target)
    return path


def write_scratch(df, name: str):
    """``df`` written as Parquet to a fresh scratch path and read back: cuts the
    lineage like a checkpoint, but columnar and compressed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(*frames) -> None:
    """Delete the files behind frames from ``write_scratch`` that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target, fs = hadoop_path(df.sparkSession, folder)
            fs.delete(target, True)


def hadoop_path(spark: SparkSession, path: str):
    """``path`` for Hadoop, and the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def is_local_master(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


__all__ = ["get_session", "checkpoint_dir", "reliable_checkpoint", "scratch_path", "write_scratch", "drop_scratch",
           "hadoop_path", "is_local_master", "DEFAULT_CONF"]
