"""Fitted preparation: median and mode imputation, scaling, ordinal codes.

Numbers and most frequent values are kept as stage parameters. The codes of the
categories are a table (column, value, code), saved beside the stage: it may have
any number of rows and is joined, never collected.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import categorical_columns, numeric_columns
from loanloom.operators.features import (
    DROPPED_COLUMNS,
    CyclicalEncoder,
    DropColumns,
    ExternalSourceAggregator,
    IsUnemployedFlagger,
    PlannedFeatures,
    RatioFeatureCreator,
    SentinelImputer,
)
from loanloom.operators.bins import Bin, finite, long_values
from loanloom.operators.quantiles import exact_quantiles, long_quantiles
from loanloom.session import cut_lineage

FEATURES = "features"
_DOUBLES = "array<double>"


def column_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; a column without values is left out."""
    found = exact_quantiles(df, columns, [0.5])
    return {c: v[0] for c, v in found.items() if v[0] is not None}


def impute_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    )


def scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) of complete columns from one aggregate over
    vectors. A constant column, up to rounding, gets deviation 1."""
    if not columns:
        return {}
    doubles = df.select([F.col(c).cast("double").alias(c) for c in columns])
    rows = VectorAssembler(inputCols=columns, outputCol="v", handleInvalid="skip").transform(
        doubles
    )
    seen = rows.agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    ).select("s.count", "s.mean", "s.variance").first()
    n = seen["count"]
    if not n:
        return {}
    result = {}
    for c, mean, sample in zip(columns, seen["mean"], seen["variance"], strict=True):
        variance = float(sample) * (n - 1) / n
        result[c] = (float(mean), _spread(n, float(mean), variance))
    return result


def _spread(n: int, mean: float, variance: float) -> float:
    """The population deviation; 1 for a column that is constant up to rounding."""
    eps = sys.float_info.epsilon
    noise = n * eps * variance + (n * mean * eps) ** 2
    return 1.0 if variance <= noise else variance**0.5


@dataclass
class NumericFit:
    medians: dict[str, float]
    scaling: dict[str, tuple[float, float]]


def fit_numbers(
    df: DataFrame, columns: list[str], part: str | None = None, members: list[list[int]] | None = None
) -> list[NumericFit]:
    """Medians of each group of rows, and mean and deviation of its columns with
    their gaps filled by them; without ``part``, of all rows as one group.

    The columns are stored once as one array, whose numbers are then counted by
    bracket for all columns together, once by part: groups overlap, and add up what
    their parts have. Filled gaps are equal values, so their share in mean and
    deviation follows from how many there are.
    """
    n, width = 1 + max((g for m in members or [[0]] for g in m), default=-1), len(columns)
    if not columns:
        return [NumericFit({}, {}) for _ in range(n)]
    array = F.array(*[finite(F.col(f"`{c}`")) for c in columns]).alias("values")
    stored = cut_lineage(df.select(array, *([part] if part else [])))
    if part:
        sizes = {r[part]: r["count"] for r in stored.groupBy(part).count().collect()}
        groups = [[p for p, of in enumerate(members) if g in of] for g in range(n)]
    else:
        sizes, groups = {0: stored.count()}, [[0]]
    values = long_values(stored, F.col("values"), width, part=F.col(part) if part else None)
    seen = values.groupBy("column", *(["part"] if part else [])).agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.count("v").alias("n"),
        F.avg("v").alias("mean"),
        F.var_pop("v").alias("variance"),
    )
    of_columns: list[dict] = [{} for _ in columns]
    for r in seen.collect():
        of_columns[r["column"]][r["part"] if part else 0] = r
    whole, moments = [], []
    for group in groups:
        for own in of_columns:
            held = [own[p] for p in group if p in own]
            # brackets of all groups begin alike
            low, high = (f((r[e] for r in own.values()), default=None) for f, e in ((min, "low"), (max, "high")))
            counted = tuple(own[p]["n"] if p in own else 0 for p in range(len(members))) if part else None
            whole.append(Bin(low, high, sum(r["n"] for r in held), counted))
            moments.append(_joint_moments([(r["n"], r["mean"], r["variance"]) for r in held]))
    medians = long_quantiles(values, whole, [0.5], groups if part else None)
    out = []
    for g in range(n):
        fit, total = NumericFit({}, {}), sum(sizes.get(p, 0) for p in groups[g])
        for i, c in enumerate(columns, g * width):
            held = whole[i].rows
            if not held:
                continue
            median, (mean, variance) = medians[i][0], moments[i]
            gaps = total - held
            apart = mean - median
            filled = mean - apart * gaps / total
            variance = variance * held / total + apart * apart * held / total * gaps / total
            fit.medians[c] = median
            fit.scaling[c] = (filled, _spread(total, filled, variance))
        out.append(fit)
    return out


def _joint_moments(parts: list[tuple[int, float, float]]) -> tuple[float, float]:
    """Mean and population variance of all rows, from (rows, mean, variance) of parts."""
    rows, mean, variance = 0, 0.0, 0.0
    for n, m, v in parts:
        rows += n
        share, apart = n / rows, m - mean
        variance = variance * (1 - share) + v * share + apart * apart * share * (1 - share)
        mean = m if share == 1 else mean + apart * share
    return mean, variance


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(spread)
            for c, (mean, spread) in fitted.items()
        }
    )


def _category_counts(df: DataFrame, columns: list[str], *beside: str) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(*beside, F.inline(entries))
        .where("value is not null")
        .groupBy(*beside, "column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def fit_categories(
    df: DataFrame, columns: list[str]
) -> tuple[dict[str, str], DataFrame | None]:
    """Most frequent value per column (the smallest wins a tie), and the codes
    (column, value, code) of all distinct values in ascending order.

    Values are sorted by ranges; a value's code is its place in its range after
    the values of the ranges before. Only one row per column is collected.
    """
    if not columns:
        return {}, None
    modes, codes = _codes(cut_lineage(_category_counts(df, columns)))
    return {c: modes[c] for c in columns if c in modes}, codes


def _codes(counts: DataFrame) -> tuple[dict[str, str], DataFrame]:
    first = F.min(F.struct((-F.col("rows")).alias("n"), "value")).alias("first")
    modes = {
        r["column"]: r["first"]["value"] for r in counts.groupBy("column").agg(first).collect()
    }
    ranged = counts.select("column", "value").repartitionByRange("column", "value")
    ranged = cut_lineage(ranged.withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select(
        "column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("column", "part").orderBy("value"))
    codes = ranged.withColumn("place", place).join(parts, ["column", "part"])
    code = (F.col("place") - 1 + F.col("before")).cast("double").alias("code")
    return modes, cut_lineage(codes.select("column", "value", code))


def fit_categories_of_groups(
    df: DataFrame, columns: list[str], part: str, members: list[list[int]]
) -> list[tuple[dict[str, str], DataFrame | None]]:
    """``fit_categories`` of several overlapping groups of rows at once. Column
    ``part`` numbers the rows' parts, and ``members`` lists the groups of each part:
    values are counted once by part, and the counts are added up by group."""
    n = 1 + max((g for groups in members for g in groups), default=-1)
    if not columns:
        return [({}, None)] * n
    counted = cut_lineage(_category_counts(df, columns, part))
    of_part = F.array(*[F.array(*[F.lit(g) for g in groups]).cast("array<int>") for groups in members])
    grouped = counted.select(F.explode(of_part[F.col(part)]).alias("group"), "column", "value", "rows")
    name = F.concat_ws(":", "group", "column").alias("column")
    counts = grouped.groupBy(name, "value").agg(F.sum("rows").alias("rows"))
    modes, codes = _codes(cut_lineage(counts))
    out = []
    for g in range(n):
        named = codes.where(F.col("column").startswith(f"{g}:"))
        short = F.expr("substring(column, instr(column, ':') + 1)")
        found = {c: modes[f"{g}:{c}"] for c in columns if f"{g}:{c}" in modes}
        out.append((found, named.select(short.alias("column"), "value", "code")))
    return out


def impute_modes(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items()})


def ordinal_encode(df: DataFrame, codes: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Replaces each of ``columns`` (name -> name in ``codes``) by the position
    of its value among the sorted categories; unseen values give -1."""
    for i, (name, fitted) in enumerate(columns.items()):
        of_column = codes.where(F.col("column") == fitted).select(
            F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}")
        )
        df = df.join(of_column, df[f"`{name}`"].cast("string") == F.col(f"_value{i}"), "left")
        df = df.withColumn(name, F.coalesce(F.col(f"_code{i}"), F.lit(-1.0)))
        df = df.drop(f"_value{i}", f"_code{i}")
    return df


# --------------------------------------------------------------------------
# stages


class ColumnPreparation(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Chooses numeric and text columns when fitted, fits imputation, scaling
    and codes for them, and assembles one vector: numeric columns first.

    ``passThrough`` columns are kept beside the vector; those named in
    ``exclude`` (id, label, fold, weight) never become features. Other columns
    are not kept.
    """

    passThrough = Param(
        Params._dummy(), "passThrough", "columns kept as they are", TypeConverters.toListString
    )
    exclude = Param(
        Params._dummy(), "exclude", "columns that are no features", TypeConverters.toListString
    )

    @keyword_only
    def __init__(
        self, *, passThrough: list[str] | None = None, exclude: list[str] | None = None
    ):
        super().__init__()
        self._setDefault(passThrough=[], exclude=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ColumnPreparationModel:
        numbers, texts = self._columns(dataset)
        (numeric,) = fit_numbers(dataset, numbers)
        return self._model(numbers, texts, numeric, *fit_categories(dataset, texts))

    def fit_groups(
        self, dataset: DataFrame, part: str, members: list[list[int]]
    ) -> list[ColumnPreparationModel]:
        """A fitted stage for each of several overlapping groups of rows, from the
        same few passes as one: ``members`` lists the groups of each number in
        column ``part``. The training sets of a cross-validation are such groups."""
        numbers, texts = self._columns(dataset)
        numeric = fit_numbers(dataset, numbers, part, members)
        categories = fit_categories_of_groups(dataset, texts, part, members)
        return [
            self._model(numbers, texts, fit, *found)
            for fit, found in zip(numeric, categories, strict=True)
        ]

    def _columns(self, dataset: DataFrame) -> tuple[list[str], list[str]]:
        exclude = self.getOrDefault(self.exclude)
        return numeric_columns(dataset, exclude), categorical_columns(dataset, exclude)

    def _model(
        self,
        numbers: list[str],
        texts: list[str],
        numeric: NumericFit,
        modes: dict[str, str],
        codes: DataFrame | None,
    ) -> ColumnPreparationModel:
        fitted = {
            "numeric": [c for c in numbers if c in numeric.medians],
            "categorical": [c for c in texts if c in modes],
            "medians": numeric.medians,
            "scaling": numeric.scaling,
            "modes": modes,
        }
        model = ColumnPreparationModel(
            fitted=json.dumps(fitted), passThrough=self.getOrDefault(self.passThrough)
        )
        model.codes = codes
        return model


class _WithCodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.codes is not None:
            self.instance.codes.write.parquet(f"{path}/codes")


class _WithCodesReader(DefaultParamsReader):
    def load(self, path: str) -> ColumnPreparationModel:
        model = super().load(path)
        if model.values["categorical"]:
            model.codes = self.sparkSession.read.parquet(f"{path}/codes")
        return model


class ColumnPreparationModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "fitted values as JSON", TypeConverters.toString)
    passThrough = Param(
        Params._dummy(), "passThrough", "columns kept as they are", TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, fitted: str = "{}", passThrough: list[str] | None = None):
        super().__init__()
        self._setDefault(fitted="{}", passThrough=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.codes: DataFrame | None = None

    def write(self) -> _WithCodesWriter:
        return _WithCodesWriter(self)

    @classmethod
    def read(cls) -> _WithCodesReader:
        return _WithCodesReader(cls)

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))

    @property
    def feature_names(self) -> list[str]:
        values = self.values
        return [f"num__{c}" for c in values["numeric"]] + [
            f"cat__{c}" for c in values["categorical"]
        ]

    def _columns(self, dataset: DataFrame) -> tuple[list, list, list]:
        """Kept columns, filled and scaled numbers, and filled texts."""
        values = self.values
        keep = [c for c in self.getOrDefault(self.passThrough) if c in dataset.columns]
        modes = values["modes"]
        kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
        numbers = []
        for c in values["numeric"]:
            mean, spread = values["scaling"][c]
            filled = F.coalesce(F.col(c).cast("double"), F.lit(values["medians"][c]))
            numbers.append(((filled - F.lit(mean)) / F.lit(spread)).alias(f"num__{c}"))
        texts = [
            F.coalesce(F.col(c), F.lit(modes[c])).alias(f"cat__{c}")
            for c in values["categorical"]
        ]
        return kept, numbers, texts

    def _coded(self, ready: DataFrame, dataset: DataFrame, features: list) -> DataFrame:
        """Texts of ``ready`` as codes; the kept columns have their names again."""
        coded = ordinal_encode(
            ready, self.codes, {f"cat__{c}": c for c in self.values["categorical"]}
        )
        keep = [c for c in self.getOrDefault(self.passThrough) if c in dataset.columns]
        return coded.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], *features)

    def prepared_columns(self, dataset: DataFrame) -> DataFrame:
        """The pass-through columns and one double column per feature."""
        kept, numbers, texts = self._columns(dataset)
        return self._coded(dataset.select(*kept, *numbers, *texts), dataset, self.feature_names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # the numbers are one array from the start: rows of a hundred columns and more
        # would be copied by the join of every text column, and outside generated code
        kept, numbers, texts = self._columns(dataset)
        ready = dataset.select(*kept, F.array(*numbers).cast(_DOUBLES).alias("_numbers"), *texts)
        codes = [F.col(f"cat__{c}") for c in self.values["categorical"]]
        vector = F.concat(F.col("_numbers"), F.array(*codes).cast(_DOUBLES))
        # NaN is the largest of numbers
        invalid = F.raise_error(F.lit("a feature is NaN")).cast(_DOUBLES)
        checked = F.when(F.isnan(F.array_max(vector)), invalid).otherwise(vector)
        return self._coded(ready, dataset, [array_to_vector(checked).alias(FEATURES)])


def build_pipeline(
    drop: list[str] | None = None,
    beside: list[str] | None = None,
    keep: list[str] | None = None,
    planned: bool = False,
) -> Pipeline:
    """The unfitted chain from raw columns to the feature vector. ``beside``
    columns are kept and are no features; ``keep`` columns are kept as well."""
    beside, keep = list(beside or []), list(keep or [])
    drop = [c for c in (DROPPED_COLUMNS if drop is None else drop) if c not in beside + keep]
    stages = [
        SentinelImputer(),
        IsUnemployedFlagger(),
        RatioFeatureCreator(),
        ExternalSourceAggregator(),
        CyclicalEncoder(),
        DropColumns(columnsToDrop=drop),
        ColumnPreparation(passThrough=list(dict.fromkeys(beside + keep)), exclude=beside),
    ]
    if planned:
        stages.insert(5, PlannedFeatures())
    return Pipeline(stages=stages)


def fit_pipeline(
    df: DataFrame,
    label: str = "TARGET",
    beside: list[str] | None = None,
    keep: list[str] | None = None,
    drop: list[str] | None = None,
    planned: bool = False,
) -> PipelineModel:
    """Fit on raw rows; the label always passes beside the features."""
    beside = list(dict.fromkeys([label, *(beside or [])]))
    return build_pipeline(drop, beside, keep, planned).fit(df)


def get_feature_names(model: PipelineModel) -> list[str]:
    for stage in model.stages:
        if isinstance(stage, ColumnPreparationModel):
            return stage.feature_names
    raise ValueError("the model holds no fitted preparation")


def keep_beside(model: PipelineModel, columns: list[str]) -> PipelineModel:
    """The same fitted chain with further input columns kept beside the vector."""
    stages = []
    for stage in model.stages:
        if isinstance(stage, ColumnPreparationModel):
            kept = [*stage.getOrDefault(stage.passThrough), *columns]
            codes = stage.codes
            stage = ColumnPreparationModel(
                fitted=stage.getOrDefault(stage.fitted), passThrough=list(dict.fromkeys(kept))
            )
            stage.codes = codes
        stages.append(stage)
    return PipelineModel(stages=stages)


def same_output(first: PipelineModel, second: PipelineModel, sample: DataFrame) -> bool:
    """Do two fitted chains agree on every row of a sample? The sample has to be
    the same rows each time it is read: a stored one, or a hash sample."""
    from pyspark.ml.functions import vector_to_array

    outputs = [
        m.transform(sample).select(
            F.transform(vector_to_array(FEATURES), lambda x: F.round(x, 9)).alias("f")
        )
        for m in (first, second)
    ]
    both = [outputs[0].exceptAll(outputs[1]), outputs[1].exceptAll(outputs[0])]
    return reduce(lambda a, b: a and b, (d.isEmpty() for d in both))
