"""The shared tables seen as loan tables, and what moves when they are aggregated."""

import re

import pytest
from pyspark.sql import functions as F

from loanloom.operators import applicants
from loanloom.plans.catalog.credit_view import loan_table, loan_tables


@pytest.fixture
def fixed_plans(spark):
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["POS_CASH_balance", "installments_payments"])
def test_lines_meet_their_orders_in_one_way_at_every_size(spark, tmp_path, name):
    """A small order table is not sent to every task, so that what moves grows with
    the input; each side moves its loan columns, no wide source columns."""
    orders = "SELECT 7L AS o_orderkey, 3L AS o_custkey, TIMESTAMP'2002-01-05' AS o_orderdate"
    lines = (
        "SELECT 7L AS l_orderkey, 11L AS l_partkey, 45L AS l_suppkey, 2 AS l_linenumber, 5D AS l_quantity,"
        " 99.5D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, 'A' AS l_returnflag,"
        " 'F' AS l_linestatus, TIMESTAMP'2002-01-09' AS l_shipdate"
    )
    spark.sql(orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = loan_table(spark, str(tmp_path), name)
    text = plan(found)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    for moved in re.findall(r"Exchange hashpartitioning.*\n.*Project \[(.*)\]", text):
        assert not re.search(r"(?:^|, )[lo]_\w+#\d+L?(?:,|$)", moved)
    row = found.first().asDict()
    wanted = {
        "POS_CASH_balance": {"SK_ID_CURR": 3, "SK_ID_PREV": 11, "SK_DPD": 5, "MONTHS_BALANCE": -2},
        "installments_payments": {"SK_ID_CURR": 3, "SK_ID_PREV": 7, "DAYS_ENTRY_PAYMENT": 8, "DAYS_INSTALMENT": 4},
    }[name]
    assert {k: row[k] for k in wanted} == wanted


def test_loans_are_counted_without_the_other_partial_values(spark, fixed_plans):
    rows = [(1, 5, -1), (1, 5, -2), (1, 6, -1), (1, None, -3), (2, None, -1), (None, 5, -1)]
    pos = spark.createDataFrame(rows, "SK_ID_CURR int, SK_ID_PREV int, MONTHS_BALANCE short")
    pos = pos.select(
        "*",
        *[F.lit(1.0).cast("float").alias(c) for c in ("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")],
        *[F.lit(2).cast("short").alias(c) for c in ("SK_DPD", "SK_DPD_DEF")],
        F.lit("Completed").alias("NAME_CONTRACT_STATUS"),
    )
    found = applicants.aggregate_pos_cash(pos)
    assert found.columns[-2:] == ["POS_LOAN_COUNT", "POS_COMPLETED_RATE"]
    got = {r["SK_ID_CURR"]: (r["POS_LOAN_COUNT"], r["POS_MONTHS_BALANCE_SIZE"]) for r in found.collect()}
    assert got == {1: (2, 4), 2: (0, 1)}
    by_loan = [s for s in plan(found).split("\n") if re.search(r"keys=\[SK_ID_CURR#\d+, SK_ID_PREV#\d+\]", s)]
    assert by_loan and all("functions=[]" in s for s in by_loan)


def test_tables_over_lines_share_one_stored_join(spark, tmp_path):
    """Lines meet their orders once for all loan tables, repeated and missing keys
    included; reading the tables moves nothing."""
    spark.sql(
        "SELECT k AS o_orderkey, c AS o_custkey, 'F' AS o_orderstatus, 5D AS o_totalprice,"
        " TIMESTAMP'2002-01-05' AS o_orderdate, '1-URGENT' AS o_orderpriority"
        " FROM VALUES (7L, 3L), (7L, 4L), (8L, NULL), (NULL, 3L) AS t(k, c)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT k AS l_orderkey, 11L AS l_partkey, 45L AS l_suppkey, n AS l_linenumber, q AS l_quantity,"
        " 99.5D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, 'A' AS l_returnflag,"
        " 'F' AS l_linestatus, TIMESTAMP'2002-01-09' AS l_shipdate"
        " FROM VALUES (7L, 1, 5D), (7L, 1, 5D), (8L, 2, NULL), (8L, 7, 6D), (9L, 1, 1D), (NULL, 1, 1D)"
        " AS t(k, n, q)"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(
        "SELECT 3L AS c_custkey, 'a' AS c_name, 1 AS c_nationkey, 1D AS c_acctbal, 'BUILDING' AS c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    tables = loan_tables(spark, str(tmp_path))
    for name in ("POS_CASH_balance", "installments_payments"):
        alone, shared = loan_table(spark, str(tmp_path), name), tables[f"{name}.csv"]
        assert "Join" not in plan(shared) and "Exchange" not in plan(shared)
        assert shared.dtypes == alone.dtypes
        assert sorted(map(str, shared.collect())) == sorted(map(str, alone.collect()))
        assert shared.count() == 6
