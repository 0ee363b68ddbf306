"""The driver contract, and one oracle comparison per theme at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from check_queries import compare

SAMPLE = [
    "wide_table",
    "agg_grandchild",
    "label_correlation",
    "quantile_clip_histogram",
    "prepared_features",
    "quality_expectations",
    "contract_violations",
    "roc_auc",
    "cost_threshold_sweep",
    "subgroup_metrics",
    "stratified_folds",
    "leakage_audit",
    "psi_drift",
]


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_names_agree():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) >= 80


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    frame = driver.queries()[name](spark, sf_dir)
    assert compare(frame, connection, driver.oracle_sql()[name]) == "same"
