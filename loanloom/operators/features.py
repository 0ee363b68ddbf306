"""Stateless feature steps, each a function and a pipeline stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.missing import null_flag, value_to_null
from loanloom.functions.scalars import (
    cycle_angle,
    ratio,
    row_mean,
    row_null_count,
    row_std,
    weekday_number,
    years_from_days,
)

# The sentinel for "not employed", the external scores and the
# columns left out of the feature set.
EMPLOYED_SENTINEL = 365243
EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
DROPPED_COLUMNS = [
    "SK_ID_CURR",
    "DAYS_EMPLOYED",
    "WEEKDAY_APPR_PROCESS_START",
    "COMMONAREA_MODE",
    "COMMONAREA_MEDI",
    "NONLIVINGAPARTMENTS_MODE",
    "NONLIVINGAPARTMENTS_MEDI",
    "LIVINGAPARTMENTS_MODE",
    "LIVINGAPARTMENTS_MEDI",
    "FLOORSMIN_MODE",
    "FLOORSMIN_MEDI",
    "YEARS_BUILD_MODE",
    "YEARS_BUILD_MEDI",
    "LANDAREA_MODE",
    "LANDAREA_MEDI",
    "BASEMENTAREA_MODE",
    "BASEMENTAREA_MEDI",
    "NONLIVINGAREA_MODE",
    "NONLIVINGAREA_MEDI",
    "ELEVATORS_MODE",
    "ELEVATORS_MEDI",
    "APARTMENTS_MODE",
    "APARTMENTS_MEDI",
    "ENTRANCES_MODE",
    "ENTRANCES_MEDI",
    "LIVINGAREA_MODE",
    "LIVINGAREA_MEDI",
    "FLOORSMAX_MODE",
    "FLOORSMAX_MEDI",
    "TOTALAREA_MODE",
    "FLAG_MOBIL",
    "FLAG_DOCUMENT_2",
    "FLAG_DOCUMENT_10",
    "FLAG_DOCUMENT_12",
    "FLAG_DOCUMENT_17",
    "FLAG_DOCUMENT_19",
    "FLAG_DOCUMENT_20",
    "FLAG_DOCUMENT_21",
]


def sentinel_to_null(
    df: DataFrame, column: str = "DAYS_EMPLOYED", sentinel: int = EMPLOYED_SENTINEL
) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, value_to_null(F.col(column), sentinel))


def flag_missing(
    df: DataFrame, column: str = "DAYS_EMPLOYED", output: str = "IS_UNEMPLOYED"
) -> DataFrame:
    """1 where the column is missing; 0 everywhere if there is no such column."""
    if column not in df.columns:
        return df.withColumn(output, F.lit(0))
    return df.withColumn(output, null_flag(F.col(column)))


def _add_available(df: DataFrame, recipes: dict) -> DataFrame:
    """Add every feature whose input columns exist."""
    made = {
        name: build()
        for name, (inputs, build) in recipes.items()
        if all(c in df.columns for c in inputs)
    }
    return df.withColumns(made) if made else df


def _shifted_ratio(numerator: str, denominator: str, shift: int):
    shifted = F.col(denominator).cast("double") + F.lit(float(shift))
    return ratio(F.col(numerator), shifted)


RATIO_INPUTS = {
    "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL", 1),
    "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL", 1),
    "CREDIT_TERM": ("AMT_ANNUITY", "AMT_CREDIT", 1),
    "DAYS_EMPLOYED_RATIO": ("DAYS_EMPLOYED", "DAYS_BIRTH", -1),
}


def add_ratios(df: DataFrame, ratios: dict[str, tuple[str, str, int]] | None = None) -> DataFrame:
    """a / (b + shift) for every entry whose columns exist, and the age in
    years. A shifted denominator of exactly 0 gives NULL."""
    recipes = {
        name: ((a, b), lambda a=a, b=b, s=s: _shifted_ratio(a, b, s))
        for name, (a, b, s) in (ratios or RATIO_INPUTS).items()
    }
    recipes["AGE_YEARS"] = (("DAYS_BIRTH",), lambda: years_from_days(F.col("DAYS_BIRTH")))
    return _add_available(df, recipes)


def add_row_statistics(
    df: DataFrame, columns: list[str] | None = None, prefix: str = "EXT_SOURCE"
) -> DataFrame:
    """Mean, sample deviation and missing count across the columns present."""
    present = [F.col(c) for c in (columns or EXTERNAL_SCORES) if c in df.columns]
    if not present:
        return df
    return df.withColumns(
        {
            f"{prefix}_MEAN": row_mean(present),
            f"{prefix}_STD": row_std(present),
            f"{prefix}_MISSING_COUNT": row_null_count(present),
        }
    )


def add_weekday_cycle(
    df: DataFrame,
    column: str = "WEEKDAY_APPR_PROCESS_START",
    prefix: str = "WEEKDAY",
    period: int = 7,
) -> DataFrame:
    """Sine and cosine of the weekday; a numeric column is the day number."""
    if column not in df.columns:
        return df
    day = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        day = weekday_number(day)
    angle = cycle_angle(day, period)
    return df.withColumns({f"{prefix}_SIN": F.sin(angle), f"{prefix}_COS": F.cos(angle)})


def drop_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.drop(*(DROPPED_COLUMNS if columns is None else columns))


def add_planned_features(df: DataFrame) -> DataFrame:
    """Further ratios of the feature plan; a zero denominator gives NULL."""

    def plain(a: str, b: str):
        return (a, b), lambda: ratio(F.col(a), F.col(b))

    scores = [F.col(c) for c in EXTERNAL_SCORES]
    return _add_available(
        df,
        {
            "CREDIT_GOODS_RATIO": plain("AMT_CREDIT", "AMT_GOODS_PRICE"),
            "INCOME_PER_PERSON": (
                ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
                lambda: _shifted_ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS", 1),
            ),
            "EMPLOYMENT_YEARS": (
                ("DAYS_EMPLOYED",),
                lambda: years_from_days(
                    value_to_null(F.col("DAYS_EMPLOYED"), EMPLOYED_SENTINEL)
                ),
            ),
            "REGISTRATION_AGE_RATIO": plain("DAYS_REGISTRATION", "DAYS_BIRTH"),
            "EXT_SOURCE_PRODUCT": (
                EXTERNAL_SCORES,
                lambda: scores[0].cast("double") * scores[1] * scores[2],
            ),
            "EXT_SOURCE_MIN": (EXTERNAL_SCORES, lambda: F.least(*scores)),
            "BUREAU_ACTIVE_RATIO": plain("BUREAU_ACTIVE_LOAN_COUNT", "BUREAU_LOAN_COUNT"),
            "BUREAU_CREDIT_UTILIZATION": plain(
                "BUREAU_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_AMT_CREDIT_SUM_SUM"
            ),
            "PREV_REFUSAL_RATIO": plain("PREV_REFUSED_COUNT", "PREV_LOAN_COUNT"),
        },
    )


HISTORY_MARKERS = {
    "BUREAU": "BUREAU_LOAN_COUNT",
    "PREV": "PREV_LOAN_COUNT",
    "POS": "POS_LOAN_COUNT",
    "INST": "INST_COUNT",
}
# Columns of the plan that get an IS_NULL flag (the housing columns
# with more than half of their values missing) and ratios with their denominators.
FLAGGED_COLUMNS = [
    "EXT_SOURCE_1",
    "APARTMENTS_AVG",
    "BASEMENTAREA_AVG",
    "YEARS_BUILD_AVG",
    "COMMONAREA_AVG",
    "ELEVATORS_AVG",
    "ENTRANCES_AVG",
    "FLOORSMIN_AVG",
    "LANDAREA_AVG",
    "LIVINGAPARTMENTS_AVG",
    "LIVINGAREA_AVG",
    "NONLIVINGAPARTMENTS_AVG",
    "NONLIVINGAREA_AVG",
]
PLANNED_DENOMINATORS = {
    "CREDIT_GOODS_RATIO": ("AMT_GOODS_PRICE", 0),
    "INCOME_PER_PERSON": ("CNT_FAM_MEMBERS", 1),
    "REGISTRATION_AGE_RATIO": ("DAYS_BIRTH", 0),
    "BUREAU_ACTIVE_RATIO": ("BUREAU_LOAN_COUNT", 0),
    "BUREAU_CREDIT_UTILIZATION": ("BUREAU_AMT_CREDIT_SUM_SUM", 0),
    "PREV_REFUSAL_RATIO": ("PREV_LOAN_COUNT", 0),
}
MISSING_CATEGORY_COLUMNS = [
    "OCCUPATION_TYPE",
    "FONDKAPREMONT_MODE",
    "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE",
]


def add_planned_imputation(df: DataFrame, flagged: list[str] | None = None) -> DataFrame:
    """Rules of the feature plan that need no fit: history flags and IS_NULL
    flags are taken first, then counts and sums become 0, a ratio whose
    denominator is 0 or missing becomes 0, the late-status rate becomes 0, text
    gaps become "Missing" and the age of a car that is not owned becomes 0. Other
    gaps, such as a ratio that only lacks its numerator, are left to the median
    step. Every rule looks at the columns as they came."""
    flags = {
        f"{prefix}_HAS_HISTORY": F.col(marker).isNotNull().cast("int")
        for prefix, marker in HISTORY_MARKERS.items()
        if marker in df.columns
    }
    flagged = FLAGGED_COLUMNS if flagged is None else flagged
    flags |= {f"{c}_IS_NULL": null_flag(F.col(c)) for c in flagged if c in df.columns}
    denominators = {n: (b, shift) for n, (_, b, shift) in RATIO_INPUTS.items()}
    denominators |= PLANNED_DENOMINATORS
    filled = {}
    for name in df.columns:
        ours = name.split("_")[0] in {*HISTORY_MARKERS, "BB"}
        counted = name.endswith(("_COUNT", "_SUM", "_SIZE"))
        if (ours and counted) or name == "BB_DPD_RATE":
            filled[name] = F.coalesce(F.col(name), F.lit(0).cast(df.schema[name].dataType))
        elif name in denominators and denominators[name][0] in df.columns:
            below, shift = denominators[name]
            undefined = F.col(below).isNull() | (F.col(below) + F.lit(shift) == 0)
            filled[name] = F.when(undefined, F.lit(0.0)).otherwise(F.col(name))
        elif name in MISSING_CATEGORY_COLUMNS:
            filled[name] = F.coalesce(F.col(name), F.lit("Missing"))
    if {"OWN_CAR_AGE", "FLAG_OWN_CAR"} <= set(df.columns):
        no_car = F.col("OWN_CAR_AGE").isNull() & (F.col("FLAG_OWN_CAR") == "N")
        filled["OWN_CAR_AGE"] = F.when(no_car, F.lit(0)).otherwise(F.col("OWN_CAR_AGE"))
    changes = flags | filled
    return df.withColumns(changes) if changes else df


# --------------------------------------------------------------------------
# pipeline stages


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A stage that applies one of the functions above."""


class SentinelImputer(_Stage):
    """Sentinel days of employment become NULL."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sentinel_to_null(dataset)


class IsUnemployedFlagger(_Stage):
    """IS_UNEMPLOYED; comes after ``SentinelImputer``."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return flag_missing(dataset)


class RatioFeatureCreator(_Stage):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_ratios(dataset)


class ExternalSourceAggregator(_Stage):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_row_statistics(dataset)


class CyclicalEncoder(_Stage):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_weekday_cycle(dataset)


class PlannedFeatures(_Stage):
    """The optional features and imputation rules of the feature plan."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_planned_imputation(add_planned_features(dataset))


class DropColumns(_Stage):
    columnsToDrop = Param(
        Params._dummy(), "columnsToDrop", "columns to leave out", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, columnsToDrop: list[str] | None = None):
        super().__init__()
        self._setDefault(columnsToDrop=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return drop_columns(dataset, self.getOrDefault(self.columnsToDrop))
