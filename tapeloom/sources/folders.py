"""The folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local master may do without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"tapeloom-{context.applicationId}")
    return folder.rstrip("/")


def fresh(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared(spark)}/{what}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system that Spark reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))
