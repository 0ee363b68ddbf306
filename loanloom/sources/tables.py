"""Parquet, CSV and JSON tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from loanloom.functions.missing import nan_to_null


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with NaN read as NULL; an absent path is an error."""
    try:
        return nan_to_null(spark.read.parquet(path))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(f"no table at {path}; build it first") from error
        raise


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_table(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def publish_table(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a finished table in place of ``path``. The older table is moved
    aside first and comes back if the move of the new one fails."""
    files, place = _place(spark, path)
    _, new = _place(spark, fresh)
    _, old = _place(spark, f"{fresh}.replaced")
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        files.delete(old, True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
