"""Where files live: existence and size of folders, scratch folders, small text files.

Small files are written and read through the session's file system, without a Spark job.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of data files and their bytes, from one file system call and no Spark job."""
    fs, hadoop_path = _hadoop_path(spark, path)
    summary = fs.getContentSummary(hadoop_path)
    _, marker = _hadoop_path(spark, f"{path}/_SUCCESS")
    return summary.getFileCount() - int(fs.exists(marker)), summary.getLength()


def list_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder, by their place in it, with their bytes: a listing and no Spark job."""
    fs, hadoop_path = _hadoop_path(spark, path)
    found, files = {}, fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        if not status.getPath().getName().startswith(("_", ".")):
            place = str(status.getPath().toUri().getPath()).split(f"/{hadoop_path.getName()}/", 1)[1]
            found[place] = status.getLen()
    return found


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    fs, hadoop_path = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; FileExistsError if there is one of this name."""
    fs, hadoop_path = _hadoop_path(spark, path)
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            raise FileExistsError(path) from error
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _hadoop_path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move_aside(spark: SparkSession, path: str, target: str) -> None:
    fs, hadoop_path = _hadoop_path(spark, path)
    fs.rename(hadoop_path, _hadoop_path(spark, target)[1])


def remove_scratch(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``scratch_folder`` named, with all that was written there."""
    if not re.search(r"/(stratakit-)?[0-9a-f]{32}$", folder):
        raise ValueError(f"not a scratch folder: {folder}")
    fs, hadoop_path = _hadoop_path(spark, folder)
    fs.delete(hadoop_path, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only a local session
    may leave that setting out; it then gets a temporary folder that goes away with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/stratakit-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="stratakit-", ignore_cleanup_errors=True)
    return f"{_local_scratch.name}/{uuid.uuid4().hex}"
