"""Choosing and naming columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def aggregate_name(prefix: str, column: str, function: str) -> str:
    return f"{prefix}_{column}_{function}".upper()


def cast_numeric_to_float(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Every numeric column as 32-bit float, for the stored wide table."""
    names = set(numeric_columns(df, exclude))
    return df.select(
        [F.col(c).cast("float").alias(c) if c in names else F.col(c) for c in df.columns]
    )


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Features without the label, and the label alone."""
    return df.drop(label), df.select(label)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
