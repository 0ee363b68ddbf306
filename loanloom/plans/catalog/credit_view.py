"""The shared test tables seen as the loan tables.

customer is the applicant, orders are loans and earlier applications, lineitem
holds monthly status, balances and repayments. Both engines read the same
column expressions; only the day difference is written differently. Amounts are
decimals, so that sums do not depend on row order.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from loanloom.plans.catalog.base import table
from loanloom.session import cut_lineage

# sums of up to 8 digits stay within 18 digits, which Spark adds as plain longs
_MONEY = "DECIMAL(8, 2)"

_FROM = {
    "application_train": "customer",
    "bureau": "orders",
    "bureau_balance": "lineitem",
    "previous_application": "orders",
    "POS_CASH_balance": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "installments_payments": "lineitem JOIN orders ON l_orderkey = o_orderkey",
}

COLUMNS = {
    "application_train": {
        "SK_ID_CURR": "CAST(c_custkey AS INT)",
        "TARGET": "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS TINYINT)",
        "NAME_CONTRACT_TYPE": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Revolving loans'"
        " ELSE 'Cash loans' END",
        "CODE_GENDER": "CASE WHEN c_nationkey = 7 THEN 'XNA' WHEN c_nationkey % 3 = 0 THEN 'M'"
        " ELSE 'F' END",
        "CNT_CHILDREN": "CAST(c_nationkey % 4 AS TINYINT)",
        "AMT_INCOME_TOTAL": "CAST(20000 + c_nationkey * 1500 + (c_custkey % 97) * 250 AS FLOAT)",
        "AMT_CREDIT": "CAST(nullif((c_custkey % 53) * 10000, 0) AS FLOAT)",
        "AMT_ANNUITY": "CAST(CASE WHEN c_custkey % 211 <> 0 THEN 900 + (c_custkey % 71) * 30 END"
        " AS FLOAT)",
        "AMT_GOODS_PRICE": "CAST((c_custkey % 53) * 9000 AS FLOAT)",
        "NAME_INCOME_TYPE": "c_mktsegment",
        "NAME_EDUCATION_TYPE": "CASE WHEN c_nationkey < 20 THEN concat('level ',"
        " CAST(c_nationkey % 5 AS VARCHAR(2))) END",
        "DAYS_BIRTH": "CAST(-(7300 + (c_custkey % 50) * 365) AS INT)",
        "DAYS_EMPLOYED": "CAST(CASE WHEN c_custkey % 6 = 0 THEN 365243"
        " ELSE -(c_custkey % 4000) END AS INT)",
        "DAYS_REGISTRATION": "CAST(-(c_custkey % 3000) AS FLOAT)",
        "OWN_CAR_AGE": "CAST(CASE WHEN c_nationkey % 3 = 1 THEN c_custkey % 20 END AS FLOAT)",
        "FLAG_OWN_CAR": "CASE WHEN c_nationkey % 3 = 1 THEN 'Y' ELSE 'N' END",
        "CNT_FAM_MEMBERS": "CAST(1 + c_nationkey % 5 AS FLOAT)",
        "OCCUPATION_TYPE": "CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END",
        "REGION_RATING_CLIENT": "CAST(1 + c_nationkey % 3 AS TINYINT)",
        "WEEKDAY_APPR_PROCESS_START": "CASE c_nationkey % 9 WHEN 0 THEN 'MONDAY'"
        " WHEN 1 THEN 'TUESDAY' WHEN 2 THEN 'wednesday' WHEN 3 THEN 'THURSDAY'"
        " WHEN 4 THEN 'Friday' WHEN 5 THEN 'SATURDAY' WHEN 6 THEN 'SUNDAY'"
        " WHEN 7 THEN 'holiday' END",
        "EXT_SOURCE_1": "CAST(CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 64) / 64e0 END"
        " AS FLOAT)",
        "EXT_SOURCE_2": "CAST(CASE WHEN c_custkey % 41 > 0 THEN (c_nationkey % 32) / 32e0 END"
        " AS FLOAT)",
        "EXT_SOURCE_3": "CAST(CASE WHEN c_custkey % 5 > 0 THEN ((c_custkey * 7) % 128) / 128e0"
        " END AS FLOAT)",
    },
    "bureau": {
        "SK_ID_CURR": "CAST(o_custkey AS INT)",
        "SK_ID_BUREAU": "CAST(o_orderkey AS INT)",
        "CREDIT_ACTIVE": "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed'"
        " ELSE 'Sold' END",
        "DAYS_CREDIT": "DAYS(o_orderdate)",
        "CREDIT_DAY_OVERDUE": "CAST(o_orderkey % 30 AS SMALLINT)",
        "DAYS_CREDIT_ENDDATE": "CASE WHEN o_orderpriority <> '5-LOW' THEN"
        " DAYS(o_orderdate) + 365 END",
        "AMT_CREDIT_MAX_OVERDUE": f"CASE WHEN o_orderpriority = '1-URGENT'"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
        "CNT_CREDIT_PROLONG": "CAST(o_orderkey % 3 AS TINYINT)",
        "AMT_CREDIT_SUM": f"CAST(o_totalprice AS {_MONEY})",
        "AMT_CREDIT_SUM_DEBT": f"CASE WHEN o_orderstatus = 'O'"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
        "AMT_CREDIT_SUM_OVERDUE": f"CASE WHEN o_orderstatus = 'P' AND o_orderpriority < '2'"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
        "DAYS_CREDIT_UPDATE": "DAYS(o_orderdate) + 10",
        "AMT_ANNUITY": f"CASE WHEN o_orderpriority = '2-HIGH'"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
    },
    "bureau_balance": {
        # every 50th supplier's rows point to a loan that does not exist
        "SK_ID_BUREAU": "CAST(CASE WHEN l_suppkey % 50 = 0 THEN l_orderkey + 1000000000"
        " ELSE l_orderkey END AS INT)",
        "MONTHS_BALANCE": "CAST(-l_linenumber AS SMALLINT)",
        "STATUS": "CASE WHEN l_linenumber = 3 THEN NULL WHEN l_returnflag = 'A' THEN '0'"
        " WHEN l_returnflag = 'N' THEN 'C' WHEN l_linestatus = 'O' THEN 'X' ELSE '1' END",
    },
    "previous_application": {
        "SK_ID_CURR": "CAST(o_custkey AS INT)",
        "SK_ID_PREV": "CAST(o_orderkey AS INT)",
        "NAME_CONTRACT_STATUS": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Refused'"
        " WHEN '5-LOW' THEN 'Canceled' ELSE 'Approved' END",
        "AMT_ANNUITY": f"CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS {_MONEY}) END",
        "AMT_APPLICATION": f"CAST(o_totalprice AS {_MONEY})",
        "AMT_CREDIT": f"CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS {_MONEY}) END",
        "AMT_DOWN_PAYMENT": f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
        "AMT_GOODS_PRICE": f"CASE WHEN o_orderkey % 4 > 0"
        f" THEN CAST(o_totalprice AS {_MONEY}) END",
        "RATE_DOWN_PAYMENT": f"CAST(o_orderkey % 100 AS {_MONEY})",
        "DAYS_DECISION": "DAYS(o_orderdate)",
        "CNT_PAYMENT": "CASE WHEN o_orderkey % 10 > 0 THEN CAST(o_orderkey % 48 AS INT) END",
        "DAYS_FIRST_DRAWING": "CASE WHEN o_orderkey % 20 = 0 THEN DAYS(o_orderdate) END",
        "DAYS_FIRST_DUE": "DAYS(o_orderdate) + 30",
        "DAYS_LAST_DUE": "CASE WHEN o_orderstatus = 'F' THEN DAYS(o_orderdate) + 300 END",
        "DAYS_TERMINATION": "CASE WHEN o_orderstatus = 'F' THEN DAYS(o_orderdate) + 310 END",
    },
    "POS_CASH_balance": {
        "SK_ID_CURR": "CAST(o_custkey AS INT)",
        "SK_ID_PREV": "CAST(l_partkey AS INT)",
        "MONTHS_BALANCE": "CAST(-l_linenumber AS SMALLINT)",
        "CNT_INSTALMENT": "CAST(l_quantity AS FLOAT)",
        "CNT_INSTALMENT_FUTURE": "CAST(CASE WHEN l_linenumber > 1 THEN l_quantity END AS FLOAT)",
        "NAME_CONTRACT_STATUS": "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A'"
        " THEN 'Completed' ELSE 'Active' END",
        "SK_DPD": "CAST(l_suppkey % 40 AS SMALLINT)",
        "SK_DPD_DEF": "CAST(l_suppkey % 7 AS SMALLINT)",
    },
    "installments_payments": {
        "SK_ID_CURR": "CAST(o_custkey AS INT)",
        "SK_ID_PREV": "CAST(o_orderkey AS INT)",
        "NUM_INSTALMENT_VERSION": "CAST(l_suppkey % 4 AS FLOAT)",
        "NUM_INSTALMENT_NUMBER": "CAST(l_linenumber AS SMALLINT)",
        "DAYS_INSTALMENT": "DAYS(o_orderdate)",
        "DAYS_ENTRY_PAYMENT": "CASE WHEN l_linenumber < 7 THEN DAYS(l_shipdate) END",
        "AMT_INSTALMENT": f"CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS {_MONEY})"
        f" ELSE CAST(0 AS {_MONEY}) END",
        "AMT_PAYMENT": f"CASE WHEN l_tax > 0 THEN CAST(l_quantity * 1000 AS {_MONEY}) END",
    },
}


def _days(expression: str, write: str) -> str:
    """Replace DAYS(x) by the day difference as one engine writes it."""
    out = expression
    for column in ("o_orderdate", "l_shipdate"):
        out = out.replace(f"DAYS({column})", write.format(column))
    return out


def _columns(name: str) -> dict[str, str]:
    write = "datediff({}, DATE'2002-01-01')"
    return {column: _days(expr, write) for column, expr in COLUMNS[name].items()}


def loan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One loan table (named without ``.csv``) over the shared tables."""
    columns = _columns(name)
    if " JOIN " not in _FROM[name]:
        source = table(spark, folder, _FROM[name])
        if "o_totalprice" in source.columns:  # cast once a row, not once a column
            price = f"CAST(o_totalprice AS {_MONEY})"
            source = source.selectExpr("*", f"{price} AS _price")
            columns = {column: expr.replace(price, "_price") for column, expr in columns.items()}
        return source.selectExpr(*[f"{expr} AS {column}" for column, expr in columns.items()])
    return _joined(spark, folder, {name: columns})[name]


def _joined(
    spark: SparkSession, folder: str, wanted: dict[str, dict[str, str]], stored: bool = False
) -> dict[str, DataFrame]:
    """Loan tables over lines and their orders, by name, all from one join. It is
    stored when several tables, or several steps, read it."""
    expressions = {e for own in wanted.values() for e in own.values()}
    reads = {e: set(re.findall(r"\b[lo]_\w+", e)) for e in expressions}
    users = Counter(c for columns in reads.values() for c in columns)
    # each side is narrowed before it moves to the join: to loan columns, and for several
    # tables to what more than one of their columns is computed from
    early = {e for e in reads if len(wanted) == 1 or all(users[c] == 1 for c in reads[e])}
    moved = {e: f"_{i}" for i, e in enumerate(sorted(early))}
    moved |= {c: c for e in sorted(expressions - early) for c in sorted(reads[e])}
    sides = []
    for side, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        own = {e: c for e, c in moved.items() if re.search(rf"\b{key[0]}_", e)}
        columns = [f"{e} AS {c}" for e, c in own.items()]
        sides.append(table(spark, folder, side).selectExpr(f"{key} AS _{key}", *columns))
    lines, orders = sides
    # orders grow with their lines: dealt by order at any size, never sent to every task
    joined = lines.join(orders.hint("merge"), lines["_l_orderkey"] == orders["_o_orderkey"])
    joined = joined.select(*moved.values())
    if stored:
        joined = cut_lineage(joined)
    return {
        name: joined.selectExpr(*[f"{moved[e] if e in early else e} AS {c}" for c, e in own.items()])
        for name, own in wanted.items()
    }


def loan_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All loan tables. Those over lines and orders come from one stored join: the
    wide row reads it three times, and storing by applicant twice a table."""
    over_lines = {n: _columns(n) for n in COLUMNS if " JOIN " in _FROM[n]}
    found = _joined(spark, folder, over_lines, stored=True)
    return {f"{n}.csv": found[n] if n in found else loan_table(spark, folder, n) for n in COLUMNS}


def loan_sql(*names: str) -> str:
    """The same tables as common table expressions (without WITH)."""
    write = "CAST(date_diff('day', TIMESTAMP '2002-01-01', {}) AS INTEGER)"
    parts = []
    for name in names:
        columns = ", ".join(
            f"{_days(expr, write)} AS {column}" for column, expr in COLUMNS[name].items()
        )
        parts.append(f"{name} AS (SELECT {columns} FROM {_FROM[name]})")
    return ", ".join(parts)
