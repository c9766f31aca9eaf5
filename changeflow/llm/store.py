"""Intermediate tables in the folder that the cluster's executors share.

A table written here cuts lineage: an executor that is lost later costs no
recomputation, and everything that reads the table twice sees the same rows.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where none is set, in local mode a temporary folder of the one machine
    there is.  A cluster has to name a folder that all its executors reach:
    any other would lose what they write.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="changeflow-")
    atexit.register(_remove_local, folder)
    spark.conf.set(SETTING, folder)
    return folder


def _remove_local(folder: str) -> None:
    import shutil

    shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)


#: Bytes of an Arrow batch between the JVM and Python workers, and the setting.
BATCH_BYTES, BATCH_SETTING = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default: texts are long, and both
    sides hold whole batches.  Whatever the user set stays."""
    if not spark._jsparkSession.sessionState().conf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


#: Whether Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: What is being collected by ``dropped``, innermost last.
_collected: list[list[Scratch]] = []


@contextmanager
def dropped() -> Iterator[None]:
    """Deletes the tables that operators write inside, at the end.

    For callers that save an operator's result themselves, with a ``Scratch``
    made outside; a result that is read later needs its tables.
    """
    mine: list[Scratch] = []
    _collected.append(mine)
    try:
        yield
    finally:
        _collected.remove(mine)
        for scratch in mine:
            scratch.remove()


class Scratch:
    """The tables of one run of an operator, each under a name of its own."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"
        # what is still there when the driver ends is deleted then
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        if _collected:
            _collected[-1].append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return what was written.

        Its shuffle files go as soon as it is written; executors that are lost
        while it is being written are made up for as ever.
        """
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path(name))
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            self._delete(self.path(name))

    def remove(self) -> None:
        """Delete all tables."""
        self._delete(self.root)

    def _delete(self, place: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
