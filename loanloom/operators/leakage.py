"""Does one column alone give the label away?

Every numeric column is split once at the value that lowers the Gini impurity
most; the AUC of the two-sided score is the finding.

The best split is searched by bounds. Rows are counted in bins of their column, and
only the counts are shuffled. The gain is a convex function of the positive and
negative rows on the left, so inside a bin it is at most what it would be at the
four corners between the bin's ends. Only bins whose bound reaches the best split
found at an end are looked into, value by value; most columns need few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.columns import numeric_columns
from loanloom.operators.bins import Bracket, _bin_number, _within, finite
from loanloom.operators.prefix import running_totals
from loanloom.session import cut_lineage

#: Bins of a column, and the share of its rows from which a bin is cut again.
BINS = 1024
HEAVY = 32

# Stand-in for a missing value, and the flag limits.
MISSING_VALUE = -999
LEAK_ABOVE = 0.80
INVESTIGATE_ABOVE = 0.70


def _purity(pos: Column, n: Column) -> Column:
    """Of a split with ``pos`` positives among ``n`` rows on the left; larger is
    better. An empty side adds nothing."""
    right_pos, right = F.col("total_pos") - pos, F.col("total_n") - n
    neg, right_neg = n - pos, right - right_pos
    sides = [(pos, neg, n), (right_pos, right_neg, right)]
    return sum(F.coalesce(F.try_divide(p * p + q * q, m), F.lit(0.0)) for p, q, m in sides)


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _bounded(cells: DataFrame) -> DataFrame:
    """Cells (column, bin, part, low, high, n, pos) with what lies before them, the
    gain at their ends, a bound of the gain inside, and whether that reaches the
    column's best end."""
    column = Window.partitionBy("column")
    ascending = column.orderBy("bin", "part")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select(
        "*",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in ("pos", "n")],
        *[F.sum(c).over(column).alias(f"total_{c}") for c in ("pos", "n")],
    )
    for c in ("pos", "n"):
        placed = placed.withColumn(f"run_{c}", F.col(f"before_{c}") + F.col(c))
        for side in ("before", "run", "total"):
            placed = placed.withColumn(f"{side}_{c}", _double(f"{side}_{c}"))
    corners = []
    for pos_side in ("before", "run"):
        for neg_side in ("before", "run"):
            pos = F.col(f"{pos_side}_pos")
            corners.append(_purity(pos, pos + F.col(f"{neg_side}_n") - F.col(f"{neg_side}_pos")))
    placed = placed.withColumn("bound", F.greatest(*corners) * (1 + 1e-12))
    end = F.when(F.col("run_n") < F.col("total_n"), _purity(F.col("run_pos"), F.col("run_n")))
    placed = placed.withColumn("purity", end)
    best = F.coalesce(F.max("purity").over(column), F.lit(float("-inf")))
    return placed.withColumn("open", (F.col("low") < F.col("high")) & (F.col("bound") >= best))


def _counted(rows: DataFrame) -> DataFrame:
    cells = rows.groupBy("column", "bin", "part").agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.sum("pos").alias("pos"),
    )
    return cut_lineage(cells)


def split_cells(
    rows: DataFrame, bins: int = BINS, heavy: int = HEAVY
) -> tuple[DataFrame, DataFrame]:
    """The cells of all columns of (column, v, pos), bounded, and the rows with
    their cell. A bin that may hold the best split and has more than one in
    ``heavy`` of the rows is cut again within its own ends."""
    ends = rows.groupBy("column").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    whole = [Bracket(r["column"], r["low"], r["high"], bins=bins) for r in ends]
    first = _within(rows, whole).select(
        "column", "v", "pos", _bin_number().alias("bin"), F.lit(0).alias("part")
    )
    counted = _counted(first)
    bounded = _bounded(counted)
    # at most ``heavy`` bins a column
    crowded = bounded.where(F.col("open") & (F.col("n") * heavy > F.col("total_n")))
    again = [(r["column"], r["bin"], r["low"], r["high"], False, bins) for r in crowded.collect()]
    if not again:
        return cut_lineage(bounded), first
    ranges = rows.sparkSession.createDataFrame(
        again, "column int, bin int, from double, to double, by_magnitude boolean, bins int"
    )
    part = F.when(F.col("bins").isNotNull(), _bin_number()).otherwise(0)
    second = first.drop("part").join(F.broadcast(ranges), ["column", "bin"], "left")
    second = second.select("column", "v", "pos", "bin", part.alias("part"))
    cut_again = F.broadcast(ranges.select("column", "bin"))
    finer = _counted(second.join(cut_again, ["column", "bin"], "left_semi"))
    cells = counted.join(cut_again, ["column", "bin"], "left_anti").unionByName(finer)
    return cut_lineage(_bounded(cells)), second


def single_feature_auc(
    df: DataFrame,
    label: str,
    columns: list[str] | None = None,
    exclude: list[str] | None = None,
    bins: int = BINS,
    heavy: int = HEAVY,
    **ranges,
) -> DataFrame:
    """(feature, auc, flag) per numeric column; the strongest come first. NaN is a
    missing value."""
    names = columns or numeric_columns(df, [label, *(exclude or [])])
    missing = F.lit(float(MISSING_VALUE))
    values = F.array(*[F.coalesce(finite(F.col(f"`{c}`")), missing) for c in names])
    stored = df.where(F.col(label).isNotNull()).select(
        values.alias("values"), F.col(label).cast("bigint").alias("pos")
    )
    rows = cut_lineage(stored).select("pos", F.posexplode("values").alias("column", "v"))
    cells, placed = split_cells(rows, bins, heavy)
    inside = cells.where("open").select("column", "bin", "part", "before_pos", "before_n", "total_pos", "total_n")
    looked = placed.join(inside.select("column", "bin", "part"), ["column", "bin", "part"], "left_semi")
    looked = looked.withColumn("n", F.lit(1))
    steps = running_totals(looked, "v", ["pos", "n"], ["column", "bin", "part"], **ranges)
    steps = steps.select("column", "bin", "part", "v", "run_pos", "run_n").join(inside, ["column", "bin", "part"])
    exact = steps.select(
        "column",
        "v",
        (F.col("run_pos") + F.col("before_pos")).alias("run_pos"),
        (F.col("run_n") + F.col("before_n")).alias("run_n"),
        "total_pos",
        "total_n",
    )
    at_ends = cells.select("column", F.col("high").alias("v"), "run_pos", "run_n", "total_pos", "total_n")
    every = at_ends.unionByName(exact)
    right_pos = F.col("total_pos") - F.col("run_pos")
    right_neg = F.col("total_n") - F.col("run_n") - right_pos
    area = F.lit(0.5) * (
        F.lit(1.0)
        + F.try_divide(right_pos, F.col("total_pos"))
        - F.try_divide(right_neg, F.col("total_n") - F.col("total_pos"))
    )
    loss = -_purity(F.col("run_pos"), F.col("run_n"))
    best = F.min(
        F.when(
            F.col("run_n") < F.col("total_n"),
            F.struct(loss.alias("loss"), F.col("v").alias("value"), area.alias("area")),
        )
    )
    found = every.groupBy(F.col("column").alias("number")).agg(best.alias("best"))
    auc = F.coalesce(F.col("best.area"), F.lit(0.5))
    strength = F.greatest(auc, 1.0 - auc)
    labels = F.array(*[F.lit(c) for c in names])
    return (
        found.select(
            F.element_at(labels, F.col("number") + 1).alias("feature"),
            strength.alias("raw"),
        )
        .select(
            "feature",
            F.round("raw", 6).alias("auc"),
            F.when(F.col("raw") > LEAK_ABOVE, "LEAK")
            .when(F.col("raw") > INVESTIGATE_ABOVE, "INVESTIGATE")
            .otherwise("OK")
            .alias("flag"),
        )
        .orderBy(F.desc("auc"), "feature")
    )


def flag_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("flag").agg(F.count(F.lit(1)).alias("features"))
