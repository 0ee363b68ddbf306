"""What each loan table contributes to one applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.missing import is_not_member
from loanloom.operators.aggregates import (
    aggregate_children,
    aggregate_grandchildren,
    count_when,
    distinct_count,
    mean_guarded_ratio,
    mean_when,
    rate_when,
    size,
)
from loanloom.sources.schemas import APPLICANT_ID

# Functions per column, in the column order of the wide table.
BUREAU = {
    "DAYS_CREDIT": ["mean", "max", "min", "std"],
    "CREDIT_DAY_OVERDUE": ["mean", "max"],
    "DAYS_CREDIT_ENDDATE": ["mean", "max"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean", "max"],
    "CNT_CREDIT_PROLONG": ["sum", "mean"],
    "AMT_CREDIT_SUM": ["mean", "max", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "max", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean", "sum"],
    "DAYS_CREDIT_UPDATE": ["mean", "max"],
    "AMT_ANNUITY": ["mean", "max"],
}
BUREAU_BALANCE = {"MONTHS_BALANCE": ["mean", "min", "max", "size"]}
PREVIOUS = {
    "AMT_ANNUITY": ["mean", "max", "min"],
    "AMT_APPLICATION": ["mean", "max", "sum"],
    "AMT_CREDIT": ["mean", "max", "sum"],
    "AMT_DOWN_PAYMENT": ["mean", "max"],
    "AMT_GOODS_PRICE": ["mean", "max"],
    "RATE_DOWN_PAYMENT": ["mean", "max"],
    "DAYS_DECISION": ["mean", "max", "min"],
    "CNT_PAYMENT": ["mean", "sum"],
    "DAYS_FIRST_DRAWING": ["mean", "max"],
    "DAYS_FIRST_DUE": ["mean", "max"],
    "DAYS_LAST_DUE": ["mean", "max"],
    "DAYS_TERMINATION": ["mean", "max"],
}
POS_CASH = {
    "MONTHS_BALANCE": ["mean", "min", "max", "size"],
    "CNT_INSTALMENT": ["mean", "max"],
    "CNT_INSTALMENT_FUTURE": ["mean", "max"],
    "SK_DPD": ["mean", "max", "sum"],
    "SK_DPD_DEF": ["mean", "max", "sum"],
}
INSTALLMENTS = {
    "NUM_INSTALMENT_VERSION": ["mean", "max"],
    "NUM_INSTALMENT_NUMBER": ["mean", "max"],
    "DAYS_INSTALMENT": ["mean", "max", "min"],
    "DAYS_ENTRY_PAYMENT": ["mean", "max", "min"],
    "AMT_INSTALMENT": ["mean", "max", "sum"],
    "AMT_PAYMENT": ["mean", "max", "sum"],
}


def aggregate_bureau(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """34 columns from loans elsewhere and their monthly status. Status rows that
    were stored with their applicant are not joined again."""
    loans = aggregate_children(
        bureau,
        APPLICANT_ID,
        BUREAU,
        "BUREAU",
        {
            "BUREAU_LOAN_COUNT": size(),
            "BUREAU_ACTIVE_LOAN_COUNT": count_when(F.col("CREDIT_ACTIVE") == "Active"),
            "BUREAU_CLOSED_LOAN_COUNT": count_when(F.col("CREDIT_ACTIVE") == "Closed"),
        },
    )
    status = F.col("STATUS")
    rates = {
        "BB_STATUS_0_RATE": status == "0",
        "BB_STATUS_C_RATE": status == "C",
        "BB_DPD_RATE": is_not_member(status, ["0", "C", "X"]),
    }
    if APPLICANT_ID in balance.columns:
        months = aggregate_children(
            balance, APPLICANT_ID, BUREAU_BALANCE, "BB", {n: rate_when(c) for n, c in rates.items()}
        )
    else:
        months = aggregate_grandchildren(
            balance,
            bureau.select("SK_ID_BUREAU", APPLICANT_ID),
            "SK_ID_BUREAU",
            APPLICANT_ID,
            BUREAU_BALANCE,
            "BB",
            rates,
        )
    return loans.join(months, APPLICANT_ID, "left")


def aggregate_previous_applications(previous: DataFrame) -> DataFrame:
    """32 columns from earlier applications."""
    status = F.col("NAME_CONTRACT_STATUS")
    return aggregate_children(
        previous,
        APPLICANT_ID,
        PREVIOUS,
        "PREV",
        {
            "PREV_LOAN_COUNT": size(),
            "PREV_APPROVED_COUNT": count_when(status == "Approved"),
            "PREV_REFUSED_COUNT": count_when(status == "Refused"),
            "PREV_APPROVAL_RATE": rate_when(status == "Approved"),
        },
    )


def aggregate_pos_cash(pos: DataFrame) -> DataFrame:
    """16 columns from monthly point-of-sale and cash balances. Loans are counted
    apart: beside the other aggregates each (applicant, loan) would move with all
    of their partial values, a row for nearly every month."""
    months = aggregate_children(
        pos,
        APPLICANT_ID,
        POS_CASH,
        "POS",
        {"POS_COMPLETED_RATE": rate_when(F.col("NAME_CONTRACT_STATUS") == "Completed")},
    )
    loans = aggregate_children(
        pos, APPLICANT_ID, {}, "POS", {"POS_LOAN_COUNT": distinct_count(F.col("SK_ID_PREV"))}
    )
    *first, last = months.columns
    return months.join(loans, APPLICANT_ID).select(*first, "POS_LOAN_COUNT", last)


def aggregate_installments(installments: DataFrame) -> DataFrame:
    """20 columns from repayments: amounts, payment ratio and lateness."""
    late_days = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    return aggregate_children(
        installments,
        APPLICANT_ID,
        INSTALLMENTS,
        "INST",
        {
            "INST_COUNT": size(),
            "INST_PAYMENT_RATIO": mean_guarded_ratio(
                F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT")
            ),
            "INST_DAYS_PAST_DUE": mean_when(late_days > 0, late_days),
            "INST_LATE_PAYMENT_RATE": rate_when(late_days > 0),
        },
    )
