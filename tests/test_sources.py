import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.sources import csv_tables, tables
from loanloom.sources.schemas import LABEL, TABLE_NAMES, TABLE_SCHEMAS

BALANCE = "bureau_balance.csv"


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder)


def test_declared_column_counts():
    assert {n: len(s) for n, s in TABLE_SCHEMAS.items()} == {
        "application_train.csv": 44,
        "application_test.csv": 43,
        "bureau.csv": 17,
        "bureau_balance.csv": 3,
        "previous_application.csv": 36,
        "POS_CASH_balance.csv": 8,
        "installments_payments.csv": 8,
    }
    assert LABEL not in TABLE_SCHEMAS["application_test.csv"].names


def test_typed_scan_with_missing_tokens(spark, tmp_path):
    text = "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n2,-2,NA\n3,-3,\"\"\n4,-4,XNA\n"
    df = csv_tables.load_table(spark, write(tmp_path, BALANCE, text), BALANCE)
    assert df.schema == TABLE_SCHEMAS[BALANCE]
    assert [r["STATUS"] for r in df.orderBy("SK_ID_BUREAU").collect()] == ["C", None, None, "XNA"]


def test_quotes_and_commas(spark, tmp_path):
    text = 'SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,"a, ""b"""\n'
    df = csv_tables.load_table(spark, write(tmp_path, BALANCE, text), BALANCE)
    assert df.first()["STATUS"] == 'a, "b"'


def test_floats_read_missing_tokens_as_null(spark):
    text = spark.createDataFrame([("1.5",), ("nan",), ("NULL",), ("",)], "x string")
    schema = T.StructType([T.StructField("x", T.FloatType())])
    out = csv_tables.apply_schema(text, schema)
    assert [r["x"] for r in out.collect()] == [1.5, None, None, None]


@pytest.mark.parametrize("cell", ["abc", "40000", "1.5"])
def test_cell_that_does_not_fit_stops_the_job(spark, tmp_path, cell):
    text = f"SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,{cell},C\n"
    df = csv_tables.load_table(spark, write(tmp_path, BALANCE, text), BALANCE)
    with pytest.raises(Exception, match=f"MONTHS_BALANCE: cannot read '{cell}'"):
        df.collect()


def test_missing_integer_is_refused_unless_allowed(spark, tmp_path):
    folder = write(tmp_path, BALANCE, "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,NA,C\n")
    with pytest.raises(Exception, match="MONTHS_BALANCE"):
        csv_tables.load_table(spark, folder, BALANCE).collect()
    out = csv_tables.load_table(spark, folder, BALANCE, null_integers=True)
    assert out.first()["MONTHS_BALANCE"] is None


def test_malformed_line_stops_the_job(spark, tmp_path):
    folder = write(tmp_path, BALANCE, "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,2,C,9\n")
    with pytest.raises(Exception):
        csv_tables.load_table(spark, folder, BALANCE).collect()


def test_extra_columns_are_typed_once(spark):
    text = spark.createDataFrame(
        [("1", "5", "1", "x"), ("2", "NA", "2.5", "3")], "known string, a string, b string, c string"
    )
    schema = T.StructType([T.StructField("known", T.IntegerType())])
    extra = csv_tables.infer_extra_columns(text, schema)
    assert {f.name: f.dataType.simpleString() for f in extra} == {
        "a": "double",
        "b": "double",
        "c": "string",
    }


def test_unknown_table_and_missing_file(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown table"):
        csv_tables.load_table(spark, str(tmp_path), "other.csv")
    with pytest.raises(FileNotFoundError):
        csv_tables.load_table(spark, str(tmp_path), BALANCE)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_row_limit(spark, tmp_path):
    rows = "".join(f"{i},-1,C\n" for i in range(50))
    folder = write(tmp_path, BALANCE, "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n" + rows)
    assert csv_tables.load_table(spark, folder, BALANCE, nrows=7).count() == 7


def test_all_tables_and_their_summary(spark, tmp_path):
    for name in TABLE_NAMES:
        write(tmp_path, name, ",".join(TABLE_SCHEMAS[name].names) + "\n")
    write(tmp_path, BALANCE, "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n2,-1,C\n")
    loaded = csv_tables.load_all_tables(spark, str(tmp_path))
    assert list(loaded) == TABLE_NAMES
    out = csv_tables.table_summary(spark, str(tmp_path), [BALANCE]).first()
    size = (tmp_path / BALANCE).stat().st_size
    assert (out["table"], out["bytes"], out["rows"]) == (BALANCE, size, 2)


def test_cast_failures_are_counted(spark):
    text = spark.createDataFrame([("1", "x"), ("NA", "2"), ("300", "3")], "a string, b string")
    schema = T.StructType(
        [T.StructField("a", T.ByteType()), T.StructField("b", T.FloatType())]
    )
    out = {r["column"]: r["failures"] for r in csv_tables.cast_failures(text, schema).collect()}
    assert out == {"a": 1, "b": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None)], "id int, s string, x double")
    tables.write_table(df, str(tmp_path / "t"))
    tables.write_table(df, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t")).collect() == df.collect()
    tables.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == df.columns
    tables.write_json(df, str(tmp_path / "j"))
    assert set(spark.read.json(str(tmp_path / "j")).columns) == {"id", "s", "x"}


def test_parquet_scan_prunes_and_pushes(spark, sf_dir):
    from conftest import plan_text

    df = tables.read_table(spark, f"{sf_dir}/lineitem.parquet")
    text = plan_text(df.where(F.col("l_linenumber") > 3).select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "GreaterThan(l_linenumber,3)" in text
