"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


# RAW payloads are written shredded: a model then reads only the JSON paths it names.
SHREDDING = "spark.sql.variant.inferShreddingSchema"


def configure(spark: SparkSession) -> SparkSession:
    """Pin the one setting results depend on, UTC wall clocks, and the layout of stored payloads.

    Shuffle partitions, memory and the rest stay what the cluster was given.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(SHREDDING, None) != "true":
        spark.conf.set(SHREDDING, "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder: there the driver and the
    executor are one machine. A cluster without the setting is an error, not a silent local write.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="pitchflow-")
    spark.conf.set(CHECKPOINT_DIR, base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, in a folder of this application; nothing is created yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """Folder of everything that this application keeps while it runs."""
    return f"{shared_dir(spark)}/pitchflow/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application kept. Results that still read from it must have been written before."""
    delete_path(spark, scratch_root(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists on whatever file system it names (local, HDFS, object store)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove `path` and everything below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`, empty when it does not exist."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))
