"""From CSV files to the wide table and everything read from it."""

import random

import pytest
from pyspark.sql import types as T

from loanloom.plans import exploration, wide_table
from loanloom.plans.validation import validate
from loanloom.sources.schemas import TABLE_SCHEMAS

APPLICANTS = 60


def cell(rng, field, row):
    name, dtype = field.name, field.dataType
    fixed = {
        "SK_ID_CURR": row + 1,
        "TARGET": int(row % 7 == 0),
        "CODE_GENDER": "MF"[row % 2],
        "NAME_CONTRACT_TYPE": "Cash loans",
        "DAYS_BIRTH": -9000 - row,
        "DAYS_EMPLOYED": 365243 if row % 5 == 0 else -row,
        "REGION_RATING_CLIENT": 1 + row % 3,
        "CNT_CHILDREN": row % 3,
    }
    if name in fixed:
        return fixed[name]
    if name.startswith("EXT_SOURCE"):
        return round(rng.random(), 3)
    if isinstance(dtype, T.StringType):
        return rng.choice(["x", "y", ""])
    if isinstance(dtype, T.FloatType):
        return rng.choice(["", rng.randrange(1, 1000)]) if name != "AMT_INCOME_TOTAL" else 500
    return rng.randrange(1, 9)


def child_cell(rng, field, row):
    name = field.name
    if name == "SK_ID_CURR":
        return rng.randrange(1, APPLICANTS - 5)
    if name in ("SK_ID_BUREAU", "SK_ID_PREV"):
        return row % 40
    fixed = {
        "CREDIT_ACTIVE": ["Active", "Closed"],
        "STATUS": ["0", "C", "X", "2", ""],
        "NAME_CONTRACT_STATUS": ["Approved", "Refused", "Completed"],
    }
    if name in fixed:
        return rng.choice(fixed[name])
    return cell(rng, field, row) if not name.startswith(("DAYS", "EXT")) else -rng.randrange(900)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(8)
    path = tmp_path_factory.mktemp("tables")
    for name, schema in TABLE_SCHEMAS.items():
        main = name.startswith("application")
        lines = [",".join(schema.names) + (",EXTRA" if main else "")]
        for row in range(APPLICANTS if main else 200):
            make = cell if main else child_cell
            cells = [str(make(rng, f, row)) for f in schema]
            lines.append(",".join(cells + (["1.5"] if main else [])))
        (path / name).write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def wide(spark, folder, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("out") / "wide")
    shape = wide_table.build_wide_table(spark, folder, output).first()
    assert (shape["rows"], shape["columns"]) == (APPLICANTS, 44 + 1 + 102)
    assert 0 < shape["null_rate"] < 1
    return wide_table.load_wide_table(spark, output)


def test_wide_table_types(wide):
    aggregates = [f for f in wide.schema if f.name.startswith(("BUREAU_", "BB_", "PREV_", "POS_", "INST_"))]
    assert len(aggregates) == 102
    assert {f.dataType for f in aggregates} == {T.FloatType()}
    assert wide.schema["EXTRA"].dataType == T.DoubleType()


def test_applicants_without_history_have_gaps(wide):
    last = wide.where(f"SK_ID_CURR > {APPLICANTS - 5}")
    assert last.where("BUREAU_LOAN_COUNT is null and INST_COUNT is null").count() == 5


def test_every_exploratory_table_has_rows(wide):
    found = exploration.explore(wide)
    assert {"label_shares", "missing_matrix", "feature_distributions"} <= set(found)
    for name, frame in found.items():
        assert not frame.isEmpty(), name


def test_summary_record(spark, wide, tmp_path):
    exploration.write_summary(wide, str(tmp_path / "s"))
    out = spark.read.json(str(tmp_path / "s")).first()
    assert out["rows"] == APPLICANTS and out["columns"] == 147
    assert out["label_0_pct"] + out["label_1_pct"] == pytest.approx(100)
    assert len(out["top_features"]) == 3 and out["sentinel_count"] == 12


def test_application_gate(spark, folder):
    from loanloom.sources.csv_tables import load_table

    report = validate(load_table(spark, folder, "application_train.csv"), raise_on_failure=False)
    failed = [r["expectation"] for r in report.results.collect() if not r["success"]]
    assert report.contract_passed, report.message
    assert set(failed) <= {"not_null", "row_count_between", "column_count_between"}


def test_missing_wide_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        wide_table.load_wide_table(spark, str(tmp_path / "none"))


def test_applicants_are_shuffled_once(spark, folder):
    """Without broadcasts every join of the chain is on the applicant id, and
    only the scan of the application table feeds an exchange of its own."""
    from conftest import plan_text
    from loanloom.sources.csv_tables import load_table

    names = [n for n in TABLE_SCHEMAS if n != "application_test.csv"]
    tables = {n: load_table(spark, folder, n) for n in names}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(wide_table.wide_table(tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    tree = text.split("\n\n")[0]
    assert tree.count("SortMergeJoin LeftOuter") == 5
    # main 1, bureau 1, status 1, pairs 2 (by pair, then by loan), status by
    # applicant 1,
    # previous 1, point of sale 2 (distinct loans), instalments 1
    assert tree.count("Exchange") == 10
    assert "BroadcastNestedLoopJoin" not in tree and "CartesianProduct" not in tree


def test_failed_check_keeps_the_older_table(spark, folder, tmp_path, monkeypatch):
    output = str(tmp_path / "wide")
    wide_table.build_wide_table(spark, folder, output)
    real = wide_table.wide_table
    monkeypatch.setattr(wide_table, "wide_table", lambda tables: real(tables).limit(3))
    with pytest.raises(AssertionError):
        wide_table.build_wide_table(spark, folder, output)
    assert wide_table.load_wide_table(spark, output).count() == APPLICANTS
    assert [p.name for p in tmp_path.iterdir()] == ["wide"]
    monkeypatch.setattr(wide_table, "wide_table", real)
    wide_table.build_wide_table(spark, folder, output)
    assert [p.name for p in tmp_path.iterdir()] == ["wide"]
