import pytest
from pyspark.sql import types as T

from loanloom.operators import quality as q
from loanloom.plans.validation import ValidationError, validate


def results(df, checks):
    return {r["number"]: r for r in q.check_expectations(df, checks).collect()}


def table(spark):
    return spark.createDataFrame(
        [(1, 0, "M", 5.0), (2, 1, "F", None), (2, 0, None, 0.0), (None, 0, "Q", -1.0)],
        "id int, y int, g string, x double",
    )


def test_expectations(spark):
    out = results(
        table(spark),
        [
            q.not_null("id"),
            q.not_null("id", mostly=0.75),
            q.unique("id"),
            q.in_set("g", ["M", "F"]),
            q.between("x", low=0),
            q.between("x", low=0, strict=True),
            q.mean_between("y", 0.2, 0.3),
            q.row_count_between(1, 3),
            q.column_count_between(4, 4),
            q.column_exists("id"),
            q.in_set("absent", [1]),
        ],
    )
    passed = [out[i]["success"] for i in range(1, 12)]
    assert passed == [False, True, False, False, False, False, True, False, True, True, False]
    assert (out[1]["unexpected_count"], out[1]["unexpected_percent"]) == (1, 25.0)
    assert (out[3]["unexpected_count"], out[3]["element_count"]) == (2, 4)
    assert out[4]["unexpected_percent"] == pytest.approx(100 / 3)
    assert (out[5]["unexpected_count"], out[6]["unexpected_count"]) == (1, 2)
    assert out[7]["observed_value"] == 0.25 and out[8]["observed_value"] == 4.0


def test_range_limits_are_included_unless_strict(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    out = results(df, [q.between("x", 0, 1), q.between("x", 0, 1, strict=True)])
    assert (out[1]["success"], out[2]["success"]) == (True, False)


def test_all_missing_column_passes_value_checks(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    out = results(df, [q.between("x", 0, 1), q.mean_between("x", 0, 1), q.unique("x")])
    assert [out[i]["success"] for i in (1, 2, 3)] == [True, False, True]


def test_all_row_checks_share_one_scan(spark):
    from conftest import plan_text

    checks = [q.not_null("id"), q.in_set("g", ["M"]), q.between("x", 0), q.mean_between("y", 0, 1)]
    assert plan_text(q.check_expectations(table(spark), checks)).count("Scan ExistingRDD") <= 2


def test_application_suite_has_21_checks():
    assert len(q.APPLICATION_EXPECTATIONS) == 21
    assert len(q.APPLICATION_CONTRACT) == 14


def test_contract_reports_every_kind(spark):
    contract = [
        q.ColumnRule("id", T.IntegerType(), unique=True, rules=[q.greater_than(1)]),
        q.ColumnRule("y", T.ByteType(), rules=[q.member([0])]),
        q.ColumnRule("g", T.StringType(), nullable=True, rules=[q.member(["M", "F"])]),
        q.ColumnRule("x", T.DoubleType(), nullable=True, rules=[q.in_range(0.0, 4.0)]),
        q.ColumnRule("absent", T.StringType()),
    ]
    found = {tuple(r) for r in q.contract_violations(table(spark), contract).collect()}
    assert found == {
        ("id", "not_nullable", None, 1),
        ("id", "greater_than(1)", "1", 1),
        ("id", "unique", "2", 2),
        ("y", "dtype(tinyint)", "int", 1),
        ("y", "isin([0])", "1", 1),
        ("g", "isin(['M', 'F'])", "Q", 1),
        ("x", "in_range(0.0, 4.0)", "5.0", 1),
        ("x", "in_range(0.0, 4.0)", "-1.0", 1),
        ("absent", "column_in_dataframe", "absent", 1),
    }


def test_rejected_rows_name_their_reasons(spark):
    contract = [
        q.ColumnRule("id", T.IntegerType()),
        q.ColumnRule("x", T.DoubleType(), nullable=True, rules=[q.at_least(0)]),
    ]
    valid, rejected = q.split_valid(table(spark), contract)
    assert valid.count() == 3 and "errors" not in valid.columns
    assert rejected.first()["errors"] == ["id: not_nullable", "x: greater_than_or_equal_to(0)"]


def test_gate_raises_with_a_summary_or_returns_a_report(spark, tmp_path):
    contract = [q.ColumnRule("y", T.IntegerType(), rules=[q.member([0])])]
    checks = [q.not_null("id"), q.not_null("y")]
    with pytest.raises(ValidationError) as error:
        validate(table(spark), contract, checks)
    assert "y isin([0]) (1 rows)" in str(error.value)
    assert "1 failed: not_null(id)" in str(error.value)
    path = str(tmp_path / "report")
    report = validate(table(spark), contract, checks, raise_on_failure=False, report_path=path)
    assert not report.passed and report.results.count() == 2
    assert spark.read.json(path).count() == 2
    good = [q.ColumnRule("y", T.IntegerType())]
    assert validate(table(spark), good, [q.not_null("y")]).passed


def broken(spark):
    return spark.createDataFrame([(1, "abc"), (1, None)], "id int, amount string")


def test_wrong_types_and_absent_columns_are_reported(spark):
    checks = [
        q.between("amount", 0),
        q.mean_between("amount", 0, 1),
        q.in_set("amount", [1]),
        q.unique("id"),
        q.not_null("amount"),
        q.between("gone", 0),
    ]
    out = results(broken(spark), checks)
    assert [out[i]["success"] for i in range(1, 7)] == [False] * 6
    assert (out[4]["unexpected_count"], out[5]["unexpected_count"]) == (2, 1)
    contract = [
        q.ColumnRule("id", T.IntegerType(), unique=True),
        q.ColumnRule("amount", T.DoubleType(), rules=[q.greater_than(0)]),
        q.ColumnRule("gone", T.StringType()),
    ]
    found = {tuple(r) for r in q.contract_violations(broken(spark), contract).collect()}
    assert found == {
        ("id", "unique", "1", 2),
        ("amount", "dtype(double)", "string", 1),
        ("amount", "not_nullable", None, 1),
        ("gone", "column_in_dataframe", "gone", 1),
    }
    valid, rejected = q.split_valid(broken(spark), contract)
    assert valid.isEmpty()
    assert ["amount: dtype(double)", "gone: column_in_dataframe"] in [r["errors"] for r in rejected.collect()]
    with pytest.raises(ValidationError):
        validate(broken(spark), contract, checks)
