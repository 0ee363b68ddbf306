"""Data-quality gates: expectations with one result row each, a schema contract
that reports every violation, and a split into valid and rejected rows.

All expectations on a table are folded into one aggregate; only uniqueness
needs a job of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.scalars import ratio

@dataclass(frozen=True)
class Expectation:
    """One check. ``unexpected`` marks failing rows, ``considered`` the rows it
    looks at; ``observed`` is a table-level value that must lie in ``bounds``.
    ``needs`` is the kind of column, "number" or "text", that it can look at."""

    name: str
    column: str | None = None
    unexpected: Callable[[str], Column] | None = None
    skip_nulls: bool = True
    mostly: float = 1.0
    observed: Callable[[DataFrame], Column] | None = None
    bounds: tuple[float | None, float | None] = (None, None)
    kind: str = "rows"
    needs: str | None = None


def _kind_of_values(values: list) -> str | None:
    kinds = {"text" if isinstance(v, str) else "number" for v in values}
    return kinds.pop() if len(kinds) == 1 else None


def _fits(dtype: T.DataType, needs: str | None) -> bool:
    """Can values of the type be checked without converting them?"""
    if needs is None:
        return True
    return isinstance(dtype, T.NumericType if needs == "number" else T.StringType)


def column_exists(column: str) -> Expectation:
    return Expectation("column_exists", column, kind="schema")


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(
        "not_null",
        column,
        lambda c: F.col(c).isNull(),
        skip_nulls=False,
        mostly=mostly,
    )


def unique(column: str) -> Expectation:
    return Expectation("unique", column, kind="unique")


def in_set(column: str, values: list) -> Expectation:
    return Expectation(
        "in_set", column, lambda c: ~F.col(c).isin(values), needs=_kind_of_values(values)
    )


def between(
    column: str,
    low: float | None = None,
    high: float | None = None,
    strict: bool = False,
) -> Expectation:
    def outside(c: str) -> Column:
        tests = []
        if low is not None:
            tests.append(F.col(c) <= low if strict else F.col(c) < low)
        if high is not None:
            tests.append(F.col(c) >= high if strict else F.col(c) > high)
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    return Expectation("between", column, outside, needs="number")


def mean_between(column: str, low: float, high: float) -> Expectation:
    return Expectation(
        "mean_between",
        column,
        observed=lambda df: F.avg(column),
        bounds=(low, high),
        kind="table",
        needs="number",
    )


def row_count_between(low: int, high: int) -> Expectation:
    return Expectation(
        "row_count_between",
        observed=lambda df: F.count(F.lit(1)),
        bounds=(low, high),
        kind="table",
    )


def column_count_between(low: int, high: int) -> Expectation:
    return Expectation(
        "column_count_between",
        observed=lambda df: F.lit(len(df.columns)),
        bounds=(low, high),
        kind="table",
    )


# The checks of the application table.
APPLICATION_EXPECTATIONS = [
    column_exists("SK_ID_CURR"),
    column_exists("TARGET"),
    not_null("SK_ID_CURR"),
    not_null("TARGET"),
    not_null("AMT_INCOME_TOTAL"),
    not_null("DAYS_BIRTH"),
    not_null("CODE_GENDER"),
    unique("SK_ID_CURR"),
    mean_between("TARGET", 0.05, 0.15),
    in_set("TARGET", [0, 1]),
    in_set("CODE_GENDER", ["M", "F", "XNA"]),
    in_set("NAME_CONTRACT_TYPE", ["Cash loans", "Revolving loans"]),
    in_set("REGION_RATING_CLIENT", [1, 2, 3]),
    between("AMT_INCOME_TOTAL", low=0, strict=True),
    between("DAYS_BIRTH", high=0, strict=True),
    between("CNT_CHILDREN", low=0),
    not_null("EXT_SOURCE_2", mostly=0.90),
    not_null("AMT_CREDIT", mostly=0.99),
    not_null("AMT_ANNUITY", mostly=0.99),
    row_count_between(300_000, 320_000),
    column_count_between(100, 130),
]


def _result(
    number: int,
    check: Expectation,
    success: Column,
    observed: Column | None = None,
    elements: Column | None = None,
    unexpected: Column | None = None,
    percent: Column | None = None,
) -> Column:
    def value(column: Column | None, dtype: str, name: str) -> Column:
        return (F.lit(None) if column is None else column).cast(dtype).alias(name)

    return F.struct(
        F.lit(number).alias("number"),
        F.lit(check.name).alias("expectation"),
        F.lit(check.column).cast("string").alias("column"),
        F.coalesce(success, F.lit(False)).alias("success"),
        value(observed, "double", "observed_value"),
        value(elements, "bigint", "element_count"),
        value(unexpected, "bigint", "unexpected_count"),
        value(percent, "double", "unexpected_percent"),
    )


def _in_bounds(value: Column, bounds: tuple[float | None, float | None]) -> Column:
    low, high = bounds
    test = value.isNotNull()
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test


def _row_check(number: int, check: Expectation) -> Column:
    failing = check.unexpected(check.column)
    if check.skip_nulls:
        failing = F.col(check.column).isNotNull() & failing
        considered = F.count(F.col(check.column))
    else:
        considered = F.count(F.lit(1))
    bad = F.count_if(failing)
    passing = F.coalesce(ratio(considered - bad, considered), F.lit(1.0))
    return _result(
        number,
        check,
        passing >= check.mostly,
        elements=F.count(F.lit(1)),
        unexpected=bad,
        percent=ratio(bad, considered) * 100,
    )


def _unique_check(df: DataFrame, number: int, check: Expectation) -> DataFrame:
    per_key = df.groupBy(check.column).agg(F.count(F.lit(1)).alias("n"))
    present = F.col(check.column).isNotNull()
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(present & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("bad"),
    )
    row = _result(
        number,
        check,
        F.col("bad") == 0,
        elements=F.col("elements"),
        unexpected=F.col("bad"),
        percent=ratio(F.col("bad"), F.col("present")) * 100,
    )
    return counts.select(F.inline(F.array(row)))


def check_expectations(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """One row per expectation, in order of ``number``. A check on an absent
    column, or one of a kind that it cannot look at, fails without figures and
    without stopping the others."""
    results, separate = [], []
    types = {f.name: f.dataType for f in df.schema}
    for number, check in enumerate(checks, 1):
        exists = check.column is None or check.column in types
        exists = exists and (check.column is None or _fits(types[check.column], check.needs))
        if check.kind == "schema" or not exists:
            passed = F.lit(check.kind == "schema" and exists)
            results.append(_result(number, check, passed))
        elif check.kind == "unique":
            separate.append(_unique_check(df, number, check))
        elif check.kind == "table":
            value = check.observed(df)
            results.append(
                _result(
                    number,
                    check,
                    _in_bounds(value, check.bounds),
                    observed=value,
                    elements=F.count(F.lit(1)) if check.column else None,
                )
            )
        else:
            results.append(_row_check(number, check))
    tables = list(separate)
    if results:
        tables.insert(0, df.agg(F.array(*results).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, tables)


# --------------------------------------------------------------------------
# schema contract


@dataclass(frozen=True)
class Rule:
    """A value check with the name it is reported under, and the kind of column
    that it can look at."""

    name: str
    failing: Callable[[Column], Column]
    needs: str | None = "number"


def greater_than(limit) -> Rule:
    return Rule(f"greater_than({limit})", lambda c: c <= limit)


def at_least(limit) -> Rule:
    return Rule(f"greater_than_or_equal_to({limit})", lambda c: c < limit)


def less_than(limit) -> Rule:
    return Rule(f"less_than({limit})", lambda c: c >= limit)


def member(values: list) -> Rule:
    return Rule(f"isin({values})", lambda c: ~c.isin(values), _kind_of_values(values))


def in_range(low, high) -> Rule:
    return Rule(f"in_range({low}, {high})", lambda c: (c < low) | (c > high))


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: T.DataType
    nullable: bool = False
    unique: bool = False
    rules: list[Rule] = field(default_factory=list)


# The contract of the application table.
APPLICATION_CONTRACT = [
    ColumnRule("SK_ID_CURR", T.IntegerType(), unique=True, rules=[greater_than(0)]),
    ColumnRule("TARGET", T.ByteType(), rules=[member([0, 1])]),
    ColumnRule("AMT_INCOME_TOTAL", T.FloatType(), rules=[greater_than(0)]),
    ColumnRule("AMT_CREDIT", T.FloatType(), nullable=True, rules=[greater_than(0)]),
    ColumnRule("AMT_ANNUITY", T.FloatType(), nullable=True, rules=[greater_than(0)]),
    ColumnRule("DAYS_BIRTH", T.IntegerType(), rules=[less_than(0)]),
    ColumnRule("DAYS_EMPLOYED", T.IntegerType()),
    ColumnRule("CODE_GENDER", T.StringType(), rules=[member(["M", "F", "XNA"])]),
    ColumnRule(
        "NAME_CONTRACT_TYPE",
        T.StringType(),
        rules=[member(["Cash loans", "Revolving loans"])],
    ),
    ColumnRule("EXT_SOURCE_1", T.FloatType(), nullable=True, rules=[in_range(0.0, 1.0)]),
    ColumnRule("EXT_SOURCE_2", T.FloatType(), nullable=True, rules=[in_range(0.0, 1.0)]),
    ColumnRule("EXT_SOURCE_3", T.FloatType(), nullable=True, rules=[in_range(0.0, 1.0)]),
    ColumnRule("REGION_RATING_CLIENT", T.ByteType(), rules=[member([1, 2, 3])]),
    ColumnRule("CNT_CHILDREN", T.ByteType(), rules=[at_least(0)]),
]


def _schema_failures(df: DataFrame, contract: list[ColumnRule]) -> list[tuple[str, str, str]]:
    types = {f.name: f.dataType for f in df.schema}
    failures = []
    for rule in contract:
        if rule.name not in types:
            failures.append((rule.name, "column_in_dataframe", rule.name))
        elif types[rule.name] != rule.dtype:
            failures.append(
                (
                    rule.name,
                    f"dtype({rule.dtype.simpleString()})",
                    types[rule.name].simpleString(),
                )
            )
    return failures


def contract_violations(df: DataFrame, contract: list[ColumnRule]) -> DataFrame:
    """Every violation as (column, check, failure_case, rows): rows counts how
    often the failing value occurs. Types are compared, never converted: a column
    of the wrong kind is a failure of its type, and its values are not looked at.
    Columns outside the contract are ignored; missing values skip value checks.
    Of a repeated key every row is a failure."""
    types = {f.name: f.dataType for f in df.schema}
    present = [r for r in contract if r.name in types]
    entries, duplicates = [], []
    for rule in present:
        column = F.col(rule.name)
        if not rule.nullable:
            entries.append((column.isNull(), rule.name, "not_nullable"))
        for check in rule.rules:
            if _fits(types[rule.name], check.needs):
                failing = column.isNotNull() & check.failing(column)
                entries.append((failing, rule.name, check.name))
        if rule.unique:
            duplicates.append(
                df.where(column.isNotNull())
                .groupBy(column.alias("key"))
                .agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1")
                .select(
                    F.lit(rule.name).alias("column"),
                    F.lit("unique").alias("check"),
                    F.col("key").cast("string").alias("failure_case"),
                    F.col("n").alias("rows"),
                )
            )
    schema = "column string, check string, failure_case string, rows bigint"
    schema_rows = [(c, k, v, 1) for c, k, v in _schema_failures(df, contract)]
    tables = [df.sparkSession.createDataFrame(schema_rows, schema)]
    if entries:
        failed = F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(check).alias("check"),
                    F.col(name).cast("string").alias("failure_case"),
                    F.coalesce(condition, F.lit(False)).alias("failed"),
                )
                for condition, name, check in entries
            ]
        )
        tables.append(
            df.select(F.inline(failed))
            .where("failed")
            .groupBy("column", "check", "failure_case")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
    return reduce(DataFrame.unionByName, tables + duplicates)


def contract_summary(violations: DataFrame) -> DataFrame:
    """Failing rows and distinct failing values per column and check."""
    return violations.groupBy("column", "check").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("cases")
    )


# --------------------------------------------------------------------------
# valid and rejected rows


def row_errors(df: DataFrame, contract: list[ColumnRule], output: str = "errors") -> DataFrame:
    """Adds the list of violated constraints ("column: check") to every row. An
    absent column, or one whose kind no value check of it can look at, is an
    error of every row."""
    types = {f.name: f.dataType for f in df.schema}
    tests = []
    for rule in contract:
        if rule.name not in types:
            tests.append(F.lit(f"{rule.name}: column_in_dataframe"))
            continue
        column = F.col(rule.name)
        if not rule.nullable:
            tests.append(F.when(column.isNull(), F.lit(f"{rule.name}: not_nullable")))
        if not all(_fits(types[rule.name], check.needs) for check in rule.rules):
            tests.append(F.lit(f"{rule.name}: dtype({rule.dtype.simpleString()})"))
            continue
        for check in rule.rules:
            tests.append(
                F.when(check.failing(column), F.lit(f"{rule.name}: {check.name}"))
            )
    if not tests:
        return df.withColumn(output, F.array().cast("array<string>"))
    return df.withColumn(output, F.array_compact(F.array(*tests)))


def split_valid(
    df: DataFrame, contract: list[ColumnRule], output: str = "errors"
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors)."""
    checked = row_errors(df, contract, output)
    empty = F.size(output) == 0
    return checked.where(empty).drop(output), checked.where(~empty)
