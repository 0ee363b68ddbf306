"""The quality gate of the application table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from loanloom.operators.quality import (
    APPLICATION_CONTRACT,
    APPLICATION_EXPECTATIONS,
    ColumnRule,
    Expectation,
    check_expectations,
    contract_summary,
    contract_violations,
)
from loanloom.sources.tables import write_json


class ValidationError(Exception):
    """A gate was not passed; the message names the failed checks."""


@dataclass
class ValidationReport:
    violations: DataFrame
    results: DataFrame
    contract_passed: bool
    expectations_passed: bool
    message: str

    @property
    def passed(self) -> bool:
        return self.contract_passed and self.expectations_passed


def validate(
    df: DataFrame,
    contract: list[ColumnRule] | None = None,
    expectations: list[Expectation] | None = None,
    raise_on_failure: bool = True,
    report_path: str | None = None,
) -> ValidationReport:
    """Run both layers. The message lists failed contract checks and the first
    five failed expectations."""
    violations = contract_violations(df, contract or APPLICATION_CONTRACT)
    broken = contract_summary(violations).orderBy("column", "check").collect()
    results = check_expectations(df, expectations or APPLICATION_EXPECTATIONS)
    rows = sorted(results.collect(), key=lambda r: r["number"])
    failed = [r for r in rows if not r["success"]]
    # one row per check: keep the answers instead of running the job again
    results = df.sparkSession.createDataFrame(rows, results.schema)
    if report_path:
        write_json(results.coalesce(1), report_path)
    lines = []
    if broken:
        lines.append(
            "contract: "
            + "; ".join(f"{r['column']} {r['check']} ({r['rows']} rows)" for r in broken)
        )
    if failed:
        names = ", ".join(f"{r['expectation']}({r['column'] or ''})" for r in failed[:5])
        lines.append(f"expectations: {len(failed)} failed: {names}")
    report = ValidationReport(violations, results, not broken, not failed, "\n".join(lines))
    if raise_on_failure and not report.passed:
        raise ValidationError(report.message)
    return report
