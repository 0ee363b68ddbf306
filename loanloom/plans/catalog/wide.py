"""Queries on child-table aggregates and the wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.functions.columns import aggregate_name, cast_numeric_to_float
from loanloom.functions.missing import is_not_member
from loanloom.operators import aggregates as agg
from loanloom.operators import applicants
from loanloom.plans import stored_layout
from loanloom.plans.catalog.base import comparable, query, rounded, table
from loanloom.plans.catalog.credit_view import COLUMNS, loan_sql, loan_table, loan_tables
from loanloom.plans.wide_table import wide_table as build_wide

ID = "SK_ID_CURR"
# one division of exact sums
EXACT = ["_MEAN", "_RATE"]


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with an exact price that is missing for low priority."""
    return table(spark, folder, "orders").select(
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("decimal(8,2)"))
        .alias("price"),
        F.datediff("o_orderdate", F.lit("2002-01-01").cast("date")).alias("days"),
    )


_ORDERS = """
orders_view AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(8, 2)) END AS price,
    CAST(date_diff('day', TIMESTAMP '2002-01-01', o_orderdate) AS INTEGER) AS days
  FROM orders)
"""


def _sql_function(column: str, fn: str) -> str:
    forms = {
        "mean": f"CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0)",
        "min": f"min({column})",
        "max": f"max({column})",
        "sum": f"coalesce(sum({column}), 0)",
        "std": f"stddev_samp(CAST({column} AS DOUBLE))",
        "size": "count(*)",
    }
    if fn == "mean":
        return forms[fn]
    return rounded(forms[fn], 4 if fn == "std" else 6)


def _sql_spec(spec: dict[str, list[str]], prefix: str) -> str:
    return ", ".join(
        f"{_sql_function(c, fn)} AS {aggregate_name(prefix, c, fn)}"
        for c, fns in spec.items()
        for fn in fns
    )


_SPEC = {"price": ["mean", "min", "max", "sum", "std"], "days": ["mean", "min", "max"]}


@query(
    "A1 A2 A3 P10",
    f"""WITH {_ORDERS} SELECT o_custkey, {_sql_spec(_SPEC, "ORD")}, CAST(count(*) AS DOUBLE) AS ORD_COUNT
    FROM orders_view GROUP BY o_custkey""",
)
def agg_child_multi(spark: SparkSession, folder: str) -> DataFrame:
    found = agg.aggregate_children(
        _orders(spark, folder), "o_custkey", _SPEC, "ORD", {"ORD_COUNT": agg.size()}
    )
    return comparable(found, ["o_custkey"], coarse=["_STD"], exact=EXACT)


@query(
    "A5 P5",
    f"""WITH {_ORDERS} SELECT o_custkey,
      CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS closed,
      CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS BIGINT) AS pending,
      CAST(sum(CASE WHEN price > 400000 THEN 1 END) AS BIGINT) AS large
    FROM orders_view GROUP BY o_custkey""",
)
def agg_conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    return agg.aggregate_children(
        _orders(spark, folder),
        "o_custkey",
        {},
        "ORD",
        {
            "closed": agg.count_when(F.col("o_orderstatus") == "F"),
            "pending": agg.count_when(F.col("o_orderstatus") == "P"),
            "large": agg.count_when(F.col("price") > 400000),
        },
    )


@query(
    "A6 A7 P6",
    f"""WITH {_ORDERS} SELECT o_custkey,
      {rounded("sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) / CAST(count(*) AS DOUBLE)")} AS closed_rate,
      {rounded("sum(CASE WHEN nullif(o_orderpriority, '1-URGENT') IN ('2-HIGH', '3-MEDIUM') THEN NULL ELSE 1 END) / CAST(count(*) AS DOUBLE)")} AS unplanned_rate,
      {rounded("sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) / CAST(nullif(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 END), 0) AS DOUBLE)")} AS closed_of_decided
    FROM orders_view GROUP BY o_custkey""",
)
def agg_rates(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    priority = F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT"))
    found = agg.aggregate_children(
        _orders(spark, folder),
        "o_custkey",
        {},
        "ORD",
        {
            "closed_rate": agg.rate_when(status == "F"),
            "unplanned_rate": agg.rate_when(is_not_member(priority, ["2-HIGH", "3-MEDIUM"])),
            "closed_of_decided": F.try_divide(
                agg.count_when(status == "F"), agg.count_when(status != "P")
            ),
        },
    )
    return comparable(found, ["o_custkey"])


@query(
    "A4",
    f"""WITH {loan_sql("POS_CASH_balance")} SELECT SK_ID_CURR,
      count(DISTINCT SK_ID_PREV) AS loans, count(*) AS months
    FROM POS_CASH_balance GROUP BY SK_ID_CURR""",
)
def agg_distinct_items(spark: SparkSession, folder: str) -> DataFrame:
    return agg.aggregate_children(
        loan_table(spark, folder, "POS_CASH_balance"),
        ID,
        {},
        "POS",
        {"loans": agg.distinct_count(F.col("SK_ID_PREV")), "months": agg.size()},
    )


@query(
    "A4",
    f"""WITH {loan_sql("POS_CASH_balance")} SELECT SK_ID_CURR,
      count(DISTINCT SK_ID_PREV) AS loans FROM POS_CASH_balance GROUP BY SK_ID_CURR""",
)
def agg_distinct_words(spark: SparkSession, folder: str) -> DataFrame:
    return agg.distinct_per_key(
        loan_table(spark, folder, "POS_CASH_balance"), [ID], "SK_ID_PREV", "loans"
    )


@query(
    "A8 P7",
    f"""WITH {loan_sql("installments_payments")} SELECT SK_ID_CURR,
      {rounded("avg(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT END)")} AS mean_late_days
    FROM installments_payments GROUP BY SK_ID_CURR""",
)
def agg_late_mean(spark: SparkSession, folder: str) -> DataFrame:
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    found = agg.aggregate_children(
        loan_table(spark, folder, "installments_payments"),
        ID,
        {},
        "INST",
        {"mean_late_days": agg.mean_when(late > 0, late)},
    )
    return comparable(found, [ID])


@query(
    "A9 X8",
    f"""WITH {loan_sql("installments_payments")} SELECT SK_ID_CURR,
      {rounded("avg(CASE WHEN AMT_INSTALMENT > 0 THEN CAST(AMT_PAYMENT AS DOUBLE) / CAST(AMT_INSTALMENT AS DOUBLE) END)")} AS payment_ratio
    FROM installments_payments GROUP BY SK_ID_CURR""",
)
def agg_payment_ratio(spark: SparkSession, folder: str) -> DataFrame:
    found = agg.aggregate_children(
        loan_table(spark, folder, "installments_payments"),
        ID,
        {},
        "INST",
        {"payment_ratio": agg.mean_guarded_ratio(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT"))},
    )
    return comparable(found, [ID])


@query(
    "J1 A6 P6",
    """SELECT o_custkey,
      round(avg(l_linenumber), 6) + 0.0 AS "LINE_L_LINENUMBER_MEAN",
      CAST(max(l_linenumber) AS DOUBLE) AS "LINE_L_LINENUMBER_MAX",
      CAST(count(*) AS DOUBLE) AS "LINE_L_LINENUMBER_SIZE",
      CAST(sum(l_linenumber) AS DOUBLE) AS "LINE_L_LINENUMBER_SUM",
      round(sum(CASE WHEN l_returnflag = 'N' THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS open_rate,
      round(sum(CASE WHEN nullif(l_returnflag, 'A') IN ('N') THEN NULL ELSE 1 END)
        / CAST(count(*) AS DOUBLE), 6) AS not_open_rate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
)
def agg_grandchild(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag"
    )
    flag = F.col("l_returnflag")
    found = agg.aggregate_grandchildren(
        lines,
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        "o_orderkey",
        "o_custkey",
        {"l_linenumber": ["mean", "max", "size", "sum"]},
        "LINE",
        {
            "open_rate": flag == "N",
            "not_open_rate": is_not_member(F.nullif(flag, F.lit("A")), ["N"]),
        },
    )
    return comparable(found, ["o_custkey"])


_CHILD_SQL = {
    "b": f"""SELECT SK_ID_CURR, {_sql_spec(applicants.BUREAU, "BUREAU")},
      CAST(count(*) AS DOUBLE) AS BUREAU_LOAN_COUNT,
      CAST(sum(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 END) AS DOUBLE) AS BUREAU_ACTIVE_LOAN_COUNT,
      CAST(sum(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 1 END) AS DOUBLE) AS BUREAU_CLOSED_LOAN_COUNT
      FROM bureau GROUP BY SK_ID_CURR""",
    "m": f"""SELECT SK_ID_CURR, {_sql_spec(applicants.BUREAU_BALANCE, "BB")},
      sum(CASE WHEN STATUS = '0' THEN 1 END) / CAST(count(*) AS DOUBLE) AS BB_STATUS_0_RATE,
      sum(CASE WHEN STATUS = 'C' THEN 1 END) / CAST(count(*) AS DOUBLE) AS BB_STATUS_C_RATE,
      sum(CASE WHEN STATUS IN ('0', 'C', 'X') THEN NULL ELSE 1 END) / CAST(count(*) AS DOUBLE) AS BB_DPD_RATE
      FROM bureau_balance JOIN bureau USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR""",
    "p": f"""SELECT SK_ID_CURR, {_sql_spec(applicants.PREVIOUS, "PREV")},
      CAST(count(*) AS DOUBLE) AS PREV_LOAN_COUNT,
      CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 END) AS DOUBLE) AS PREV_APPROVED_COUNT,
      CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 END) AS DOUBLE) AS PREV_REFUSED_COUNT,
      sum(CASE WHEN NAME_CONTRACT_STATUS = 'Approved' THEN 1 END) / CAST(count(*) AS DOUBLE) AS PREV_APPROVAL_RATE
      FROM previous_application GROUP BY SK_ID_CURR""",
    "c": f"""SELECT SK_ID_CURR, {_sql_spec(applicants.POS_CASH, "POS")},
      CAST(count(DISTINCT SK_ID_PREV) AS DOUBLE) AS POS_LOAN_COUNT,
      sum(CASE WHEN NAME_CONTRACT_STATUS = 'Completed' THEN 1 END) / CAST(count(*) AS DOUBLE) AS POS_COMPLETED_RATE
      FROM POS_CASH_balance GROUP BY SK_ID_CURR""",
    "i": f"""SELECT SK_ID_CURR, {_sql_spec(applicants.INSTALLMENTS, "INST")},
      CAST(count(*) AS DOUBLE) AS INST_COUNT,
      {rounded("avg(CASE WHEN AMT_INSTALMENT > 0 THEN CAST(AMT_PAYMENT AS DOUBLE) / CAST(AMT_INSTALMENT AS DOUBLE) END)")} AS INST_PAYMENT_RATIO,
      {rounded("avg(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT END)")} AS INST_DAYS_PAST_DUE,
      sum(CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN 1 END) / CAST(count(*) AS DOUBLE) AS INST_LATE_PAYMENT_RATE
      FROM installments_payments GROUP BY SK_ID_CURR""",
}


@query(
    "A10 J2",
    f"""WITH {loan_sql("bureau", "bureau_balance")},
      b AS ({_CHILD_SQL["b"]}), m AS ({_CHILD_SQL["m"]})
    SELECT * FROM b LEFT JOIN m USING (SK_ID_CURR)""",
)
def aggregate_bureau(spark: SparkSession, folder: str) -> DataFrame:
    found = applicants.aggregate_bureau(
        loan_table(spark, folder, "bureau"), loan_table(spark, folder, "bureau_balance")
    )
    return comparable(found, [ID], coarse=["_STD"], exact=EXACT)


@query("A11", f"WITH {loan_sql('previous_application')} {_CHILD_SQL['p']}")
def aggregate_previous_applications(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "previous_application")
    return comparable(applicants.aggregate_previous_applications(rows), [ID], exact=EXACT)


@query("A12", f"WITH {loan_sql('POS_CASH_balance')} {_CHILD_SQL['c']}")
def aggregate_pos_cash(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "POS_CASH_balance")
    return comparable(applicants.aggregate_pos_cash(rows), [ID], exact=EXACT)


@query("A13", f"WITH {loan_sql('installments_payments')} {_CHILD_SQL['i']}")
def aggregate_installments(spark: SparkSession, folder: str) -> DataFrame:
    rows = loan_table(spark, folder, "installments_payments")
    return comparable(applicants.aggregate_installments(rows), [ID], exact=EXACT)


TEXT_COLUMNS = [
    "NAME_CONTRACT_TYPE",
    "CODE_GENDER",
    "NAME_INCOME_TYPE",
    "NAME_EDUCATION_TYPE",
    "FLAG_OWN_CAR",
    "OCCUPATION_TYPE",
    "WEEKDAY_APPR_PROCESS_START",
]
MAIN_COLUMNS = list(COLUMNS["application_train"])
_MAIN_SQL = ", ".join(
    "CAST(TARGET AS INTEGER) AS TARGET"
    if c == "TARGET"
    else c
    if c in [*TEXT_COLUMNS, ID, "DAYS_BIRTH"]
    else f"{rounded(c)} AS {c}"
    for c in MAIN_COLUMNS
)
#: Names of the aggregates, in the order of the child tables.
AGGREGATES = [
    aggregate_name(prefix, c, fn)
    for prefix, spec in (
        ("BUREAU", applicants.BUREAU),
        ("BB", applicants.BUREAU_BALANCE),
        ("PREV", applicants.PREVIOUS),
        ("POS", applicants.POS_CASH),
        ("INST", applicants.INSTALLMENTS),
    )
    for c, fns in spec.items()
    for fn in fns
] + [
    "BUREAU_LOAN_COUNT",
    "BUREAU_ACTIVE_LOAN_COUNT",
    "BUREAU_CLOSED_LOAN_COUNT",
    "BB_STATUS_0_RATE",
    "BB_STATUS_C_RATE",
    "BB_DPD_RATE",
    "PREV_LOAN_COUNT",
    "PREV_APPROVED_COUNT",
    "PREV_REFUSED_COUNT",
    "PREV_APPROVAL_RATE",
    "POS_LOAN_COUNT",
    "POS_COMPLETED_RATE",
    "INST_COUNT",
    "INST_PAYMENT_RATIO",
    "INST_DAYS_PAST_DUE",
    "INST_LATE_PAYMENT_RATE",
]
WIDE_SQL = f"""WITH {loan_sql("application_train", "bureau", "bureau_balance",
    "previous_application", "POS_CASH_balance", "installments_payments")},
  b AS ({_CHILD_SQL["b"]}), m AS ({_CHILD_SQL["m"]}), p AS ({_CHILD_SQL["p"]}),
  c AS ({_CHILD_SQL["c"]}), i AS ({_CHILD_SQL["i"]}),
  main AS (SELECT {_MAIN_SQL} FROM application_train),
  wide AS (SELECT * FROM main LEFT JOIN b USING (SK_ID_CURR) LEFT JOIN m USING (SK_ID_CURR)
    LEFT JOIN p USING (SK_ID_CURR) LEFT JOIN c USING (SK_ID_CURR)
    LEFT JOIN i USING (SK_ID_CURR))
"""


def wide(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table: all applicant columns and all 102 aggregates."""
    tables = loan_tables(spark, folder)
    main = tables["application_train.csv"]
    tables["application_train.csv"] = main.withColumn("TARGET", F.col("TARGET").cast("int"))
    return build_wide(tables, as_float32=False)


@query("A14 J3 J4", WIDE_SQL + "SELECT * FROM wide")
def wide_table(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(wide(spark, folder), [ID, "TARGET", "DAYS_BIRTH"], coarse=["_STD"], exact=EXACT)


@query(
    "A15",
    WIDE_SQL
    + f""", marks AS (SELECT count(*) AS n, {", ".join(
        f'avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) AS n{i}'
        for i, c in enumerate(MAIN_COLUMNS + AGGREGATES))} FROM wide)
    SELECT n AS "rows", CAST({len(MAIN_COLUMNS + AGGREGATES)} AS INTEGER) AS "columns",
      round(({" + ".join(f"n{i}" for i in range(len(MAIN_COLUMNS + AGGREGATES)))})
        / {len(MAIN_COLUMNS + AGGREGATES)}, 6) AS null_rate
    FROM marks""",
)
def wide_table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(agg.shape_and_null_rate(wide(spark, folder)), ["rows", "columns"])


def _stored(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All loan tables in buckets of the applicant, cut into column groups."""
    tables = loan_tables(spark, folder)
    main = tables["application_train.csv"]
    tables["application_train.csv"] = main.withColumn("TARGET", F.col("TARGET").cast("int"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stored_layout.column_groups(stored_layout.store_tables(tables, buckets), False)


@query("A14 J2 J3 J4 S8", WIDE_SQL + "SELECT * FROM wide")
def wide_from_buckets(spark: SparkSession, folder: str) -> DataFrame:
    found = stored_layout.read_columns(_stored(spark, folder))
    return comparable(found, [ID, "TARGET", "DAYS_BIRTH"], coarse=["_STD"], exact=EXACT)


@query(
    "A14 A17",
    WIDE_SQL
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END), 6)
        + 0.0 AS null_rate FROM wide"""
        for c in MAIN_COLUMNS + AGGREGATES
    ),
)
def null_rates_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(stored_layout.group_null_rates(_stored(spark, folder)))


@query(
    "J5 Q5",
    """SELECT o_custkey, count(*) AS "rows" FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
)
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return agg.duplicate_keys(table(spark, folder, "orders"), "o_custkey")


@query(
    "P11",
    """SELECT c_custkey, CAST(c_nationkey AS FLOAT) AS c_nationkey,
      CAST(c_acctbal AS FLOAT) AS c_acctbal, c_mktsegment FROM customer""",
)
def float32_cast(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").drop("c_name")
    return cast_numeric_to_float(rows, ["c_custkey"])
