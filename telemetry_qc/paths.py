"""Where intermediate tables go: the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local-mode session without one (tests)
    gets a fresh temporary folder; a cluster session without one is an error,
    as a machine-local folder is not visible to other executors.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tqc-checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True).close()


def path_version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at ``path``: another tuple once
    they change."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
