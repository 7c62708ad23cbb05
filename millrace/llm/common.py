"""What the corpus operators share: the shared folder, Arrow limits and the word pattern."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes that one Arrow batch of whole texts may hold; keeps Python workers small.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20

#: A side of at most so many narrow rows (tens of bytes each) may be broadcast, after a count.
BROADCAST_ROWS = 500_000


@cache
def _local_folder() -> str:
    """Only where spark.checkpoint.dir is unset and all runs on one machine, as in tests."""
    path = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir of the session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
    return (named or _local_folder()).rstrip("/")


def arrow_limits(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_holders: list[tuple[str, Callable[[], None]]] = []


def take_over(owner: str, release: Callable[[], None] = lambda: None) -> None:
    """Called where a task begins in a Python worker. Workers serve one operator after another; what the one before kept there goes."""
    if _holders and _holders[0][0] != owner:
        _holders.pop()[1]()
    if not _holders:
        _holders.append((owner, release))


class Workspace:
    """Tables written to the shared folder; they cut lineage and survive lost executors.

    A table that a returned DataFrame reads stays until the driver ends; steps drop
    the ones that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/millrace-{label}-{uuid.uuid4().hex}"
        atexit.register(self._forget)

    def _forget(self) -> None:
        try:
            self._delete(self.base)
        except Exception:  # the JVM may be gone at exit; nothing is left to do then
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df once and read it back; what follows never recomputes it."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that further columns of any name cannot clash."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def is_held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 = 1; a null id is never held out (nor ever labelled)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def texts(column: pa.Array) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64); wraps by design."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
