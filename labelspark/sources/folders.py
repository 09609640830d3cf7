"""Folders on storage that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, as in tests, the warehouse.

    A warehouse on a local disk is shared by nobody but a local master's tasks, so a cluster is
    refused it.
    """
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("/", "file:")) and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_base(spark)}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
