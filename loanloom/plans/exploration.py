"""Exploratory tables of the wide table and their summary record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.aggregates import null_rates
from loanloom.operators.features import EMPLOYED_SENTINEL, EXTERNAL_SCORES
from loanloom.operators.histograms import histogram, label_histograms
from loanloom.operators.profile import (
    both_tails,
    columns_partly_missing,
    label_correlations,
    label_rate_by_category,
    missing_matrix,
    null_rate_summary,
    sentinel_analysis,
    top,
    value_shares,
)
from loanloom.operators.sampling import complete_sample
from loanloom.sources.schemas import APPLICANT_ID, LABEL
from loanloom.sources.tables import write_json

# The categories whose label rates are shown.
CATEGORY_COLUMNS = [
    "NAME_CONTRACT_TYPE",
    "CODE_GENDER",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
]


def explore(df: DataFrame, label: str = LABEL, id_col: str = APPLICANT_ID) -> dict[str, DataFrame]:
    """Every exploratory table by name; charts are left to the caller."""
    rates = null_rates(df)
    correlations = label_correlations(df, label, exclude=[id_col]).where(
        "correlation is not null"
    )
    strongest = [
        r["column"]
        for r in top(
            correlations.withColumn("strength", F.abs("correlation")), "strength", "column", 12
        ).collect()
    ]
    employed = F.col("DAYS_EMPLOYED")
    tables = {
        "label_shares": value_shares(df, label),
        "null_rates": top(rates, "null_rate", "column", 40),
        "null_summary": null_rate_summary(rates),
        "feature_distributions": label_histograms(df, strongest, label, 50, (0.01, 0.99)),
        "correlations": both_tails(correlations, "correlation", "column", 15),
        "label_rates": label_rate_by_category(df, label, CATEGORY_COLUMNS),
        "external_scores": label_histograms(df, EXTERNAL_SCORES, label, 50),
        "external_pairs": complete_sample(
            df.select(id_col, label, *EXTERNAL_SCORES), id_col, [label, *EXTERNAL_SCORES], 10_000
        ),
        "employment": sentinel_analysis(df, "DAYS_EMPLOYED", EMPLOYED_SENTINEL, label),
        "employment_days": histogram(
            df,
            {
                "all": employed,
                "without_sentinel": F.when(employed != EMPLOYED_SENTINEL, employed),
            },
            100,
        ),
    }
    partly = columns_partly_missing(df)
    if partly:
        tables["missing_matrix"] = missing_matrix(df, id_col, partly)
    return tables


def summary(df: DataFrame, label: str = LABEL, id_col: str = APPLICANT_ID) -> DataFrame:
    """One row with the headline figures."""
    rates = null_rates(df)
    strongest = top(
        label_correlations(df, label, exclude=[id_col])
        .where("correlation is not null")
        .withColumn("strength", F.abs("correlation")),
        "strength",
        "column",
        3,
    ).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("strength")).alias("s"), "column"))),
            lambda x: x["column"],
        ).alias("top_features")
    )
    employed = sentinel_analysis(df, "DAYS_EMPLOYED", EMPLOYED_SENTINEL, label)
    share = F.avg((F.col(label) == 1).cast("double")) * 100
    counts = null_rate_summary(rates)
    second = F.avg(F.col("EXT_SOURCE_2").isNull().cast("double")) * 100
    figures = df.agg(
        F.count(F.lit(1)).alias("rows"),
        share.alias("label_1_pct"),
        second.alias("ext_source_2_null_pct"),
    )
    return figures.select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        (100 - F.col("label_1_pct")).alias("label_0_pct"),
        "label_1_pct",
        counts.select("above_50").scalar().alias("null_above_50"),
        counts.select("above_20").scalar().alias("null_above_20"),
        strongest.scalar().alias("top_features"),
        employed.select("sentinel_count").scalar().alias("sentinel_count"),
        employed.select("sentinel_pct").scalar().alias("sentinel_pct"),
        employed.select("sentinel_label_rate").scalar().alias("sentinel_label_rate"),
        "ext_source_2_null_pct",
    )


def write_summary(df: DataFrame, path: str) -> None:
    write_json(summary(df).coalesce(1), path)
