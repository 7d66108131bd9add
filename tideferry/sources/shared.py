"""Scratch space every executor can reach."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    A warehouse on the machine's own disk is no shared folder: without
    ``spark.checkpoint.dir`` it serves local sessions only, and raises on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if urlsplit(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {warehouse} is this machine's")
    return warehouse + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_folder(spark)}/tideferry/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, by Spark's own file systems."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
