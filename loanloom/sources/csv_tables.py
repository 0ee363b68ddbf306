"""Typed CSV scans.

A cell is read as text, missing tokens become NULL, and the rest must fit the
declared type. A cell that does not fit stops the job with its column and
value instead of turning silently into NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.missing import token_to_null
from loanloom.sources.schemas import TABLE_NAMES, TABLE_SCHEMAS

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def scan_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text. ``multi_line`` allows line breaks inside quotes,
    but then a file can no longer be split between tasks."""
    try:
        return (
            spark.read.option("header", True)
            .option("mode", "FAILFAST")
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(f"no table at {path}") from error
        raise


def _typed(name: str, dtype: T.DataType, null_integers: bool) -> Column:
    text = token_to_null(F.col(f"`{name}`"))
    if isinstance(dtype, T.StringType):
        return text.alias(name)
    value = text.try_cast(dtype)
    problem = text.isNotNull() & value.isNull()
    if isinstance(dtype, _INTEGERS) and not null_integers:
        problem = value.isNull()
    message = F.concat(
        F.lit(f"column {name}: cannot read '"),
        F.coalesce(F.col(f"`{name}`"), F.lit("")),
        F.lit(f"' as {dtype.simpleString()}"),
    )
    return F.when(problem, F.raise_error(message)).otherwise(value).alias(name)


def apply_schema(
    text: DataFrame, schema: T.StructType, null_integers: bool = False
) -> DataFrame:
    """Typed columns for a frame of text; columns outside the schema stay text.

    Integer columns refuse missing values unless ``null_integers`` is set.
    """
    types = {f.name: f.dataType for f in schema}
    return text.select(
        [_typed(c, types.get(c, T.StringType()), null_integers) for c in text.columns]
    )


def infer_extra_columns(text: DataFrame, schema: T.StructType) -> T.StructType:
    """Types of the columns that the schema does not name, from one pass:
    whole numbers without gaps are bigint, other numbers double, else text.

    Store the result and pass it back to ``load_table`` to skip the pass.
    """
    extra = [c for c in text.columns if c not in schema.names]
    if not extra:
        return T.StructType([])
    checks = []
    for i, name in enumerate(extra):
        value = token_to_null(F.col(f"`{name}`"))
        checks += [
            F.count_if(value.isNull()).alias(f"missing{i}"),
            F.count_if(value.isNotNull() & value.try_cast("bigint").isNull()).alias(
                f"not_whole{i}"
            ),
            F.count_if(value.isNotNull() & value.try_cast("double").isNull()).alias(
                f"not_number{i}"
            ),
        ]
    seen = text.agg(*checks).first()
    fields = []
    for i, name in enumerate(extra):
        if seen[f"not_number{i}"]:
            dtype = T.StringType()
        elif seen[f"not_whole{i}"] or seen[f"missing{i}"]:
            dtype = T.DoubleType()
        else:
            dtype = T.LongType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def load_table(
    spark: SparkSession,
    folder: str,
    name: str,
    nrows: int | None = None,
    extra_schema: T.StructType | None = None,
    null_integers: bool = False,
) -> DataFrame:
    """One of the seven tables with its declared types. With ``nrows`` only the
    first rows are read, also for the types of undeclared columns. A cell that
    does not fit its type is an error when its column is read; call
    ``cast_failures`` to check columns that a query leaves out."""
    if name not in TABLE_SCHEMAS:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLE_NAMES)}")
    text = scan_text(spark, f"{folder}/{name}")
    if nrows is not None:
        text = text.limit(nrows)
    declared = TABLE_SCHEMAS[name]
    if extra_schema is None:
        extra_schema = infer_extra_columns(text, declared)
    schema = T.StructType(declared.fields + extra_schema.fields)
    return apply_schema(text, schema, null_integers)


def load_all_tables(
    spark: SparkSession,
    folder: str,
    nrows: int | None = None,
    extra_schemas: dict[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """All tables by name, each read when it is used. Only files with columns
    beyond the declared ones need a typing pass, unless ``extra_schemas`` has
    their types."""
    stored = extra_schemas or {}
    return {n: load_table(spark, folder, n, nrows, stored.get(n)) for n in TABLE_NAMES}


def cast_failures(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Number of cells per declared column that do not fit its type."""
    checked = [f for f in schema if f.name in text.columns]
    counts = []
    for f in checked:
        value = token_to_null(F.col(f"`{f.name}`"))
        bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
        counts.append(
            F.struct(F.lit(f.name).alias("column"), F.count_if(bad).alias("failures"))
        )
    return text.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def file_summary(scans: dict[str, DataFrame]) -> DataFrame:
    """File bytes and row count per scan of files, whatever their format."""

    def one(name: str, scan: DataFrame) -> DataFrame:
        per_file = (
            scan.select(
                F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_size").alias("bytes"),
            )
            .groupBy("path")
            .agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        )
        return per_file.agg(
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        ).select(F.lit(name).alias("table"), "bytes", "rows")

    return reduce(DataFrame.unionByName, [one(n, scan) for n, scan in scans.items()])


def table_summary(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    return file_summary({name: scan_text(spark, f"{folder}/{name}") for name in names})
