"""Session settings and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "loanloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """A session with adaptive execution on and a fixed UTC time zone.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command names the master and adaptive execution coalesces the partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where that is unset, one
    beside the session's warehouse, which is shared as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back. Losing
    executors later re-reads files instead of repeating model fits and joins,
    and unlike a row checkpoint the table is still read column by column. The
    table goes when the session ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete an existing folder when the session ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def drop_tables(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables that are no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
