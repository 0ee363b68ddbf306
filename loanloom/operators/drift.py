"""Population stability index between a reference and a current window.

The reference can be kept as a profile: a small table of its bins with their lower
edges and row counts. Profiles with the same edges are added up, day by day, and a
current window is scored against one without reading the reference again.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.quantiles import exact_quantiles

# Fixed value: the alert limit. Bins and the smallest share are our choice.
ALERT_ABOVE = 0.2
BINS = 10
SMALLEST_SHARE = 1e-4


def _bins(df: DataFrame, edges: dict[str, list[float]], texts: list[str]) -> DataFrame:
    """(feature, bin) of every present value."""
    bounded = {n: e for n, e in edges.items() if e}
    for i, (name, cuts) in enumerate(bounded.items()):
        df = df.withColumn(f"_x{i}", F.col(f"`{name}`").cast("double"))
        df = Bucketizer(
            splits=[-math.inf, *cuts, math.inf],
            inputCol=f"_x{i}",
            outputCol=f"_bin{i}",
            handleInvalid="keep",
        ).transform(df)
    bins = [(n, F.col(f"_bin{i}").cast("int")) for i, n in enumerate(bounded)]
    bins += [(n, F.col(f"`{n}`")) for n in texts]
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.when(F.col(f"`{name}`").isNotNull(), bin_.cast("string")).alias("bin"),
        )
        for name, bin_ in bins
    ]
    return df.select(F.inline(F.array(*entries))).where("bin is not null")


def reference_edges(
    reference: DataFrame, numeric: list[str], bins: int = BINS
) -> dict[str, list[float]]:
    """Inner edges of each numeric column: its distinct quantiles."""
    probs = [i / bins for i in range(1, bins)]
    return {
        name: sorted({v for v in values if v is not None})
        for name, values in exact_quantiles(reference, numeric, probs).items()
    }


def window_profile(
    window: DataFrame, edges: dict[str, list[float]], categorical: list[str]
) -> DataFrame:
    """(feature, bin, edge, n): the rows of a window in each bin. Every numeric bin
    has a row, also without rows of the window, with its lower edge (NULL for the
    lowest); text values are bins of their own without an edge."""
    counted = _bins(window, edges, categorical).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = [
        (name, str(i), None if i == 0 else float(cuts[i - 1]))
        for name, cuts in edges.items()
        if cuts
        for i in range(len(cuts) + 1)
    ]
    numbered = window.sparkSession.createDataFrame(grid, "feature string, bin string, edge double")
    # a row per named column and bin
    numbers = F.broadcast(numbered).join(counted, ["feature", "bin"], "left")
    texts = counted.where(F.col("feature").isin(categorical)).withColumn("edge", F.lit(None).cast("double"))
    whole = numbers if grid else numbered.withColumn("n", F.lit(0).cast("bigint"))
    return whole.select("feature", "bin", "edge", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).unionByName(
        texts.select("feature", "bin", "edge", "n")
    )


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all windows together; their edges have to be the same."""
    rows = reduce(DataFrame.unionByName, profiles)
    merged = rows.groupBy("feature", "bin").agg(
        F.min("edge").alias("edge"),
        F.sum("n").alias("n"),
        (~F.min("edge").eqNullSafe(F.max("edge"))).alias("apart"),
        F.count(F.lit(1)).alias("times"),
    )
    numbers = rows.where("edge IS NOT NULL").select("feature").distinct()
    wrong = merged.where("edge IS NOT NULL").join(numbers, "feature", "left_semi")
    wrong = wrong.where(F.col("apart") | (F.col("times") != len(profiles)))
    if not wrong.isEmpty():
        raise ValueError(f"profiles with different edges: {wrong.first()['feature']}")
    return merged.select("feature", "bin", "edge", "n")


def profile_edges(profile: DataFrame) -> dict[str, list[float]]:
    """Inner edges of the numeric columns; a row per column and bin is read."""
    edges: dict[str, list[float]] = {}
    for r in profile.where("edge IS NOT NULL").select("feature", "edge").collect():
        edges.setdefault(r["feature"], []).append(r["edge"])
    return {name: sorted(cuts) for name, cuts in edges.items()}


def profile_psi_table(profile: DataFrame, current: DataFrame, categorical: list[str]) -> DataFrame:
    """``psi_table`` of a stored reference profile and a current window."""
    now = _bins(current, profile_edges(profile), categorical)
    now = now.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    return _psi(profile, now)


def psi_table(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str],
    categorical: list[str],
    bins: int = BINS,
) -> DataFrame:
    """(feature, bin, reference and current share, contribution). Numeric bins
    are the reference quantiles, each closed on the left; text values are their
    own bins. A share below 1e-4 counts as 1e-4."""
    edges = reference_edges(reference, numeric, bins)
    sides = [
        _bins(frame, edges, categorical).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
        for frame in (reference, current)
    ]
    return _psi(*sides)


def _psi(reference: DataFrame, current: DataFrame) -> DataFrame:
    """From the counts (feature, bin, n) of both windows; bins without a row in
    either are no bins."""
    sides = [
        frame.where("n > 0").select("feature", "bin", *[
            (F.col("n") if s == side else F.lit(0).cast("bigint")).alias(s)
            for s in ("reference", "current")
        ])
        for side, frame in (("reference", reference), ("current", current))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy("feature", "bin").agg(
        F.sum("reference").alias("reference"), F.sum("current").alias("current")
    )
    # one row per named feature, so safe to broadcast
    totals = counts.groupBy("feature").agg(
        F.sum("reference").alias("reference_rows"), F.sum("current").alias("current_rows")
    )

    def share(side: str):
        raw = F.coalesce(F.try_divide(F.col(side), F.col(f"{side}_rows")), F.lit(0.0))
        return F.greatest(raw, F.lit(SMALLEST_SHARE))

    old, new = F.col("reference_share"), F.col("current_share")
    return counts.join(F.broadcast(totals), "feature").select(
        "feature",
        "bin",
        share("reference").alias("reference_share"),
        share("current").alias("current_share"),
    ).withColumn("contribution", (new - old) * F.ln(new / old))


def psi_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: list[str],
    categorical: list[str],
    bins: int = BINS,
    alert_above: float = ALERT_ABOVE,
) -> DataFrame:
    """(feature, psi, alert) per feature."""
    return drift_alerts(psi_table(reference, current, numeric, categorical, bins), alert_above)


def drift_alerts(table: DataFrame, alert_above: float = ALERT_ABOVE) -> DataFrame:
    """(feature, psi, alert) of the bins of all features."""
    return table.groupBy("feature").agg(F.sum("contribution").alias("psi")).withColumn(
        "alert", F.col("psi") > alert_above
    )
