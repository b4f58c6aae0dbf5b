"""Session construction and the shared scratch folder.

Lineage cuts and intermediate tables go under ``spark.checkpoint.dir``: on a
cluster that setting names a shared folder every executor can reach. We read it
from the session and only pick a local folder ourselves when it is unset (tests,
laptop runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans from runtime statistics: it turns a
# sort-merge join into a broadcast join only when the measured side is below the
# threshold, splits skewed join partitions and coalesces small shuffle outputs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files of RDDs that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tabwise",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set for local runs; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def _drop_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder (made now if need be) deleted when the driver ends, whoever built the session."""
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, choosing a local one only if unset on a local master.

    Elsewhere executors would each write to a disk of their own, so an unset
    folder is an error. A folder set from here is deleted when the driver ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabwise-ckpt-")
    sc.setCheckpointDir(configured)
    _drop_at_end(spark, sc.getCheckpointDir())
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory, deleted when the driver ends."""
    base = ensure_checkpoint_dir(spark)
    root = base.rsplit("/", 1)[0] if "/" in base else base
    folder = f"{root}/tabwise-scratch/{uuid.uuid4().hex[:12]}"
    _drop_at_end(spark, folder)
    return f"{folder}/{name}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch path before that."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)
