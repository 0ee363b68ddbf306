"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, as in
    tests, a folder beside the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return base.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, not when the driver
    happens to collect its garbage. For writes: their plans run once."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Scratch:
    """The intermediate tables of one run. A stored table cuts the lineage: a
    lost executor costs a read of files, not the work before them. Tables that
    the returned frame no longer reads are deleted with ``drop``, all others when
    the session ends."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with shuffles_freed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        self.path(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        """A place for files of another kind, deleted when the session ends too."""
        files, place = self._place(name)
        files.mkdirs(place)  # what is not there yet cannot be marked
        files.deleteOnExit(place)
        return f"{self.folder}/{name}"

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def drop(self, *names: str) -> None:
        for name in names:
            files, place = self._place(name)
            files.delete(place, True)
