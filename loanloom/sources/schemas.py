"""Declared column types of the seven loan tables.

Columns that a file holds beyond these are typed by ``infer_extra_columns``.
"""

from __future__ import annotations

from pyspark.sql import types as T

BYTE, SHORT, INT = T.ByteType(), T.ShortType(), T.IntegerType()
FLOAT, TEXT = T.FloatType(), T.StringType()

# Column names and types of the input files, in file order.
_DECLARED = {
    "application_train.csv": [
        ("SK_ID_CURR", INT),
        ("TARGET", BYTE),
        ("NAME_CONTRACT_TYPE", TEXT),
        ("CODE_GENDER", TEXT),
        ("FLAG_OWN_CAR", TEXT),
        ("FLAG_OWN_REALTY", TEXT),
        ("CNT_CHILDREN", BYTE),
        ("AMT_INCOME_TOTAL", FLOAT),
        ("AMT_CREDIT", FLOAT),
        ("AMT_ANNUITY", FLOAT),
        ("AMT_GOODS_PRICE", FLOAT),
        ("NAME_TYPE_SUITE", TEXT),
        ("NAME_INCOME_TYPE", TEXT),
        ("NAME_EDUCATION_TYPE", TEXT),
        ("NAME_FAMILY_STATUS", TEXT),
        ("NAME_HOUSING_TYPE", TEXT),
        ("REGION_POPULATION_RELATIVE", FLOAT),
        ("DAYS_BIRTH", INT),
        ("DAYS_EMPLOYED", INT),
        ("DAYS_REGISTRATION", FLOAT),
        ("DAYS_ID_PUBLISH", INT),
        ("OWN_CAR_AGE", FLOAT),
        ("FLAG_MOBIL", BYTE),
        ("FLAG_EMP_PHONE", BYTE),
        ("FLAG_WORK_PHONE", BYTE),
        ("FLAG_CONT_MOBILE", BYTE),
        ("FLAG_PHONE", BYTE),
        ("FLAG_EMAIL", BYTE),
        ("OCCUPATION_TYPE", TEXT),
        ("CNT_FAM_MEMBERS", FLOAT),
        ("REGION_RATING_CLIENT", BYTE),
        ("REGION_RATING_CLIENT_W_CITY", BYTE),
        ("WEEKDAY_APPR_PROCESS_START", TEXT),
        ("HOUR_APPR_PROCESS_START", BYTE),
        ("REG_REGION_NOT_LIVE_REGION", BYTE),
        ("REG_REGION_NOT_WORK_REGION", BYTE),
        ("LIVE_REGION_NOT_WORK_REGION", BYTE),
        ("REG_CITY_NOT_LIVE_CITY", BYTE),
        ("REG_CITY_NOT_WORK_CITY", BYTE),
        ("LIVE_CITY_NOT_WORK_CITY", BYTE),
        ("ORGANIZATION_TYPE", TEXT),
        ("EXT_SOURCE_1", FLOAT),
        ("EXT_SOURCE_2", FLOAT),
        ("EXT_SOURCE_3", FLOAT),
    ],
    "bureau.csv": [
        ("SK_ID_CURR", INT),
        ("SK_ID_BUREAU", INT),
        ("CREDIT_ACTIVE", TEXT),
        ("CREDIT_CURRENCY", TEXT),
        ("DAYS_CREDIT", INT),
        ("CREDIT_DAY_OVERDUE", SHORT),
        ("DAYS_CREDIT_ENDDATE", FLOAT),
        ("DAYS_ENDDATE_FACT", FLOAT),
        ("AMT_CREDIT_MAX_OVERDUE", FLOAT),
        ("CNT_CREDIT_PROLONG", BYTE),
        ("AMT_CREDIT_SUM", FLOAT),
        ("AMT_CREDIT_SUM_DEBT", FLOAT),
        ("AMT_CREDIT_SUM_LIMIT", FLOAT),
        ("AMT_CREDIT_SUM_OVERDUE", FLOAT),
        ("CREDIT_TYPE", TEXT),
        ("DAYS_CREDIT_UPDATE", INT),
        ("AMT_ANNUITY", FLOAT),
    ],
    "bureau_balance.csv": [
        ("SK_ID_BUREAU", INT),
        ("MONTHS_BALANCE", SHORT),
        ("STATUS", TEXT),
    ],
    "previous_application.csv": [
        ("SK_ID_CURR", INT),
        ("SK_ID_PREV", INT),
        ("NAME_CONTRACT_TYPE", TEXT),
        ("AMT_ANNUITY", FLOAT),
        ("AMT_APPLICATION", FLOAT),
        ("AMT_CREDIT", FLOAT),
        ("AMT_DOWN_PAYMENT", FLOAT),
        ("AMT_GOODS_PRICE", FLOAT),
        ("WEEKDAY_APPR_PROCESS_START", TEXT),
        ("HOUR_APPR_PROCESS_START", BYTE),
        ("FLAG_LAST_APPL_PER_CONTRACT", TEXT),
        ("NFLAG_LAST_APPL_IN_DAY", BYTE),
        ("RATE_DOWN_PAYMENT", FLOAT),
        ("RATE_INTEREST_PRIMARY", FLOAT),
        ("RATE_INTEREST_PRIVILEGED", FLOAT),
        ("NAME_CASH_LOAN_PURPOSE", TEXT),
        ("NAME_CONTRACT_STATUS", TEXT),
        ("DAYS_DECISION", INT),
        ("NAME_PAYMENT_TYPE", TEXT),
        ("CODE_REJECT_REASON", TEXT),
        ("NAME_CLIENT_TYPE", TEXT),
        ("NAME_GOODS_CATEGORY", TEXT),
        ("NAME_PORTFOLIO", TEXT),
        ("NAME_PRODUCT_TYPE", TEXT),
        ("CHANNEL_TYPE", TEXT),
        ("SELLERPLACE_AREA", INT),
        ("NAME_SELLER_INDUSTRY", TEXT),
        ("CNT_PAYMENT", FLOAT),
        ("NAME_YIELD_GROUP", TEXT),
        ("PRODUCT_COMBINATION", TEXT),
        ("DAYS_FIRST_DRAWING", FLOAT),
        ("DAYS_FIRST_DUE", FLOAT),
        ("DAYS_LAST_DUE_1ST_VERSION", FLOAT),
        ("DAYS_LAST_DUE", FLOAT),
        ("DAYS_TERMINATION", FLOAT),
        ("NFLAG_INSURED_ON_APPROVAL", FLOAT),
    ],
    "POS_CASH_balance.csv": [
        ("SK_ID_CURR", INT),
        ("SK_ID_PREV", INT),
        ("MONTHS_BALANCE", SHORT),
        ("CNT_INSTALMENT", FLOAT),
        ("CNT_INSTALMENT_FUTURE", FLOAT),
        ("NAME_CONTRACT_STATUS", TEXT),
        ("SK_DPD", SHORT),
        ("SK_DPD_DEF", SHORT),
    ],
    "installments_payments.csv": [
        ("SK_ID_CURR", INT),
        ("SK_ID_PREV", INT),
        ("NUM_INSTALMENT_VERSION", FLOAT),
        ("NUM_INSTALMENT_NUMBER", SHORT),
        ("DAYS_INSTALMENT", FLOAT),
        ("DAYS_ENTRY_PAYMENT", FLOAT),
        ("AMT_INSTALMENT", FLOAT),
        ("AMT_PAYMENT", FLOAT),
    ],
}

APPLICANT_ID = "SK_ID_CURR"
LABEL = "TARGET"

def without_label(schema: T.StructType, label: str = LABEL) -> T.StructType:
    return T.StructType([f for f in schema if f.name != label])


def _all_schemas() -> dict[str, T.StructType]:
    schemas = {}
    for name, declaration in _DECLARED.items():
        schemas[name] = T.StructType([T.StructField(c, t) for c, t in declaration])
        if name == "application_train.csv":
            schemas["application_test.csv"] = without_label(schemas[name])
    return schemas


TABLE_SCHEMAS = _all_schemas()
TABLE_NAMES = list(TABLE_SCHEMAS)
