"""Folders for tables and layouts that are written and read again.

They lie below ``spark.checkpoint.dir``, which driver and executors share, and go when
the driver ends; only a local master without that setting gets the system's temporary folder.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_left: dict[str, SparkSession] = {}


def folder(spark: SparkSession, label: str) -> str:
    """A new path; what is written to it is removed when the driver ends, or by :func:`remove`."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "tidemark-scratch")
    path = f"{base.rstrip('/')}/layouts/{label}-{uuid.uuid4().hex}"
    if not _left:
        atexit.register(_sweep)
    _left[path] = spark
    return path


def _filesystem(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    _left.pop(path, None)
    target, files = _filesystem(spark, path)
    files.delete(target, True)


def _sweep() -> None:
    for path, spark in list(_left.items()):
        if spark.sparkContext._jsc is None:  # the session ended before
            return
        try:
            remove(spark, path)
        except Exception:  # the driver is ending; what stays is only scratch
            return


def put(spark: SparkSession, local: str, target: str) -> None:
    """Copy a file of the driver to a path on any file system."""
    to, files = _filesystem(spark, target)
    files.copyFromLocalFile(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), to)
