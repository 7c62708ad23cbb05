"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    """Only where spark.checkpoint.dir is unset and all runs on one machine, as in tests."""
    path = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's path in the shared folder that spark.checkpoint.dir names; it goes when the driver ends."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    path = f"{(named or _local_folder()).rstrip('/')}/millrace-{label}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the JVM may be gone at exit; nothing is left to do then
        pass


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return bool(fs.delete(target, True))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside and renamed over the old file in one step, so that a reader sees the old text or the new one."""
    jvm = spark._jvm
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, source = _fs(spark, beside)
    stream = fs.create(source, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target = jvm.org.apache.hadoop.fs.Path(path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
