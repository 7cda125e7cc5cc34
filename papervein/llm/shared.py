"""Tables written to the folder that the driver and all executors share.

Iterative steps write their state as Parquet under ``spark.checkpoint.dir`` and read it
back, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-tables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


# What Python workers remember from task to task: encoders with their memos.
CACHES: list[dict] = []


def forget() -> None:
    """Let a worker's memos go, where work begins that needs the memory and not them."""
    for cache in CACHES:
        cache.clear()
    release()


def release() -> None:
    """Give memory that Arrow holds in a worker for later batches back to the system."""
    pa.default_memory_pool().release_unused()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is run within as soon as it has ended, not when the
    driver happens to collect its garbage.  Nothing else reads them: each run of a frame has its own."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Tables:
    """The intermediate tables of one run, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, name: str = "step") -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        written.shared_path = path
        return written

    def drop(self, written: DataFrame) -> None:
        """Delete a table that no later step reads."""
        drop_path(self.spark, written.shared_path)


ROWS_A_TASK = 20_000


def gathered(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """A small table's many partitions dealt to fewer tasks: as many as there are cores at least,
    and one for each so many of its rows, of which ``rows`` bounds the number."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, rows // each + 1))


def first_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows of a written table that come first in the order of their key's hash.

    Rows whose hash cannot be among these are left out where they lie, so about twice ``most``
    rows are ordered, whatever the table's size.
    """
    count = rows.count()
    if count > 2 * most:
        bound = -(1 << 63) + int((1 << 64) * (2 * most / count))
        some = rows.where(F.xxhash64(key) < bound)
        if some.count() >= most:
            rows = some
    return rows.orderBy(F.xxhash64(key), key).limit(most)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
