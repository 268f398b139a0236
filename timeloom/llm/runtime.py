"""Where intermediate tables go, and when they go away."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's bound on what goes to Python at once. A task holds a batch several times, in the JVM and in Python, so its own 64 MB is too much for small executors.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

_open: list[list[Scratch]] = []


def bound_batches(spark: SparkSession) -> None:
    """Batches of at most about BATCH_BYTES, or less where the session asks for less; every row is in one."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def returning(run: Callable) -> Callable:
    """run for mapInArrow; at its end the worker, which Spark keeps, gives freed memory back to the machine."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a folder of our own on a local master, and an error on a cluster, whose machines don't share one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="timeloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Intermediate tables of one operator call, as Parquet in the shared folder.

    A written table cuts the lineage: a lost executor costs only the tasks that
    it ran since the last table. ``drop`` frees one that later steps don't read,
    ``close`` all of them, once the call's result has been consumed; what is left
    goes when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        bound_batches(spark)
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        fs, path = self._at()
        fs.mkdirs(path)  # only what exists can be marked
        fs.deleteOnExit(path)
        for made in _open:
            made.append(self)

    def _at(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """df as a written table; the shuffle files of writing it go as soon as it stands."""
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = self._at(name)
            fs.delete(path, True)

    def close(self) -> None:
        fs, path = self._at()
        fs.delete(path, True)


@contextmanager
def closing_scratch() -> Iterator[None]:
    """Deletes the tables of every operator called inside when the block ends: write or count the results inside."""
    made: list[Scratch] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for scratch in made:
            scratch.close()
