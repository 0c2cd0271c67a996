"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a small
# build side becomes a broadcast only after its size is measured), coalesces
# tiny shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "storelake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only set when given: on a cluster
    the launcher decides the one, and AQE coalesces from
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` for the other.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _master(spark: SparkSession) -> str:
    try:
        return spark.conf.get("spark.master", "") or ""
    except Exception:
        return ""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the cluster
    (a shared file system every executor can reach); if it is unset there, we
    stop rather than write to a folder only the driver can see; a ``file:`` path
    there must be a mount that all executors share. Only a local
    session (tests, ``local[*]``) without it gets a folder under the local temp
    directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _master(spark).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(e.g. on HDFS or an object store) that every executor can reach")
        d = tempfile.mkdtemp(prefix="storelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = getattr(spark, "_sc", None)     # Spark Connect has none; the folder is used by path only
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process has made; call it once their results are written.
    Returns how many there were."""
    n = len(_SCRATCH)
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
