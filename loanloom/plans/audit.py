"""Leakage audit of the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.operators.leakage import flag_counts, single_feature_auc
from loanloom.sources.schemas import APPLICANT_ID, LABEL
from loanloom.sources.tables import write_csv
from loanloom.session import cut_lineage


def run_audit(
    df: DataFrame, output: str | None = None, label: str = LABEL, id_col: str = APPLICANT_ID
) -> tuple[bool, DataFrame, DataFrame]:
    """(no column leaks, findings, number of columns per flag)."""
    findings = cut_lineage(single_feature_auc(df, label, exclude=[id_col]))
    if output:
        write_csv(findings.coalesce(1), output)
    leaks = findings.where(F.col("flag") == "LEAK").isEmpty()
    return leaks, findings, flag_counts(findings)
