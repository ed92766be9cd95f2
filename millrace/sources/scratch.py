"""A folder that the driver and all executors share, for files that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``; in a local session that has none, below a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="millrace-files-"))
        named = _local[0]
    return f"{named.rstrip('/')}/millrace-files/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> str:
    """A small file (a test case, a report) on the file system that ``path`` names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path
