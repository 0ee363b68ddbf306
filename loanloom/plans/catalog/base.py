"""Registry of the queries that run on the shared test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.sources.tables import read_table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name; ``covers`` lists operator ids."""

    def register(run: Run) -> Run:
        name = run.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, covers, run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def comparable(
    df: DataFrame,
    keep: Iterable[str] = (),
    digits: int = 6,
    coarse: Iterable[str] = (),
    exact: Iterable[str] = (),
) -> DataFrame:
    """Numbers outside ``keep`` as rounded doubles, so that two engines which
    add in different orders show the same value. Columns whose name ends in a
    ``coarse`` suffix are rounded to 4 digits. Those ending in an ``exact``
    suffix are one division of exact sums and are not rounded."""
    keep, coarse, exact = set(keep), tuple(coarse), tuple(exact)
    columns = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType) and f.name not in keep:
            column = column.cast("double")
            if not f.name.endswith(exact):
                column = F.round(column, 4 if f.name.endswith(coarse) else digits)
            # adding 0 turns a rounded -0.0 into 0.0
            column = (column + F.lit(0.0)).alias(f.name)
        columns.append(column)
    return df.select(columns)


def rounded(expression: str, digits: int = 6) -> str:
    """The SQL side of ``comparable`` for one expression."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0"
