"""Missing values: inside the library only NULL means missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings that a CSV cell may hold for "missing".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def token_to_null(column: Column) -> Column:
    return F.when(~column.isin(MISSING_TOKENS), column)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column; other columns pass unchanged."""
    floats = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floats) if floats else df


def value_to_null(column: Column, value) -> Column:
    """NULL where the column holds a sentinel value."""
    return F.nullif(column, F.lit(value))


def null_flag(column: Column) -> Column:
    return column.isNull().cast("int")


def is_not_member(column: Column, members: list) -> Column:
    """True for values outside the set; a missing value counts as outside."""
    return ~F.coalesce(column.isin(members), F.lit(False))
