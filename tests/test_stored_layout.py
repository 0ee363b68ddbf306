"""Tables in buckets of the applicant, column groups, counts by bit words."""

import random

import pytest
from pyspark.sql import functions as F

from loanloom.functions.columns import numeric_columns
from loanloom.operators import profile
from loanloom.operators.aggregates import distinct_per_key, null_rates
from loanloom.plans import stored_layout
from loanloom.plans.catalog.credit_view import loan_tables
from loanloom.plans.wide_table import wide_table
from loanloom.sources.schemas import APPLICANT_ID
from tests.conftest import plan_text


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return loan_tables(spark, sf_dir)


@pytest.fixture(scope="module")
def wider(tables):
    """224 columns in the wide row, as in the full application table."""
    main = tables["application_train.csv"]
    more = 122 - len(main.columns)
    extra = {f"EXTRA_{i}": (F.col(APPLICANT_ID) % (i + 2)).cast("float") for i in range(more)}
    return tables | {"application_train.csv": main.withColumns(extra)}


@pytest.fixture(scope="module")
def groups(wider):
    return stored_layout.column_groups(stored_layout.store_tables(wider, 4))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def rows_of(df):
    names = sorted(df.columns)
    numbers = set(numeric_columns(df))
    shown = [F.round(F.col(c), 2).alias(c) if c in numbers else F.col(c) for c in names]
    return sorted(map(str, df.select(shown).collect()))


def test_groups_make_the_wide_table(wider, groups):
    out = stored_layout.read_columns(groups)
    assert len(out.columns) == 224
    assert max(len(g.columns) for g in groups.values()) <= stored_layout.GROUP_COLUMNS
    assert rows_of(out) == rows_of(wide_table(wider))


def test_buckets_meet_without_a_shuffle(groups, no_broadcast):
    plan = plan_text(stored_layout.read_columns(groups))
    assert "Bucketed: true" in plan
    assert "Exchange" not in plan


def test_every_group_is_generated_code(spark, groups, no_broadcast):
    """Aggregates, sorts and joins carry a code generation id."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for group in groups.values():
            text = plan_text(group)
            tree = text[: text.index("\n\n\n")] if "\n\n\n" in text else text.split("(1)", 1)[0]
            assert "Exchange" not in text
            nodes = [n for n in tree.splitlines() if "Aggregate" in n or "Join" in n or "Project" in n]
            assert nodes or "Scan" in tree
            assert all("* " in n for n in nodes), tree
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_named_groups_are_read(groups):
    out = stored_layout.read_columns(groups, ["TARGET", "INST_COUNT"])
    assert out.columns == ["TARGET", "INST_COUNT"]
    assert plan_text(out).count("Location:") == 2
    with pytest.raises(ValueError, match="NOWHERE"):
        stored_layout.read_columns(groups, ["NOWHERE"])


def test_null_rates_by_group(wider, groups):
    rates = {r["column"]: r["null_rate"] for r in stored_layout.group_null_rates(groups).collect()}
    expected = {r["column"]: r["null_rate"] for r in null_rates(wide_table(wider)).collect()}
    assert rates.keys() == expected.keys()
    assert all(abs(rates[c] - expected[c]) < 1e-9 for c in rates)


def test_hot_key_is_not_bucketed(spark):
    even = spark.range(1000).select((F.col("id") % 100).alias("k"))
    hot = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"))
    assert not stored_layout.has_hot_key(even, "k", 16)
    assert stored_layout.has_hot_key(hot, "k", 16)
    assert not stored_layout.has_hot_key(even.limit(0), "k", 16)
    stored = stored_layout.store_by_key(hot, "k", 16)
    assert sorted(r.k for r in stored.collect()) == sorted(r.k for r in hot.collect())
    assert "Exchange" in plan_text(stored.groupBy("k").count())


@pytest.mark.parametrize("key", ["k", None])
def test_distinct_per_key(spark, key):
    rng = random.Random(3)
    rows = [(0 if i % 3 else i, rng.choice([None, -1, rng.randrange(-300, 300), 2**62])) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, v long")
    keys = [key] if key else []
    out = distinct_per_key(df, keys, "v", "n")
    expected = df.groupBy(*keys).agg(F.count_distinct("v").alias("n"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))


def test_words_of_close_values_share_rows(spark):
    """A third of the rows under one key; words, not values, are counted."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("k"), "id")
    out = {r.k: r.n for r in distinct_per_key(df, ["k"], "id", "n").where("n > 1 or k = 7").collect()}
    assert out == {7: 10001}
    assert "Expand" not in plan_text(distinct_per_key(df, ["k"], "id", "n"))


@pytest.mark.parametrize("cells", [4, 1 << 16])
def test_top_values_when_cells_are_shared(spark, monkeypatch, cells):
    """Few cells hold many values each; many ties; a column without values."""
    monkeypatch.setattr(profile, "CELLS", cells)
    rng = random.Random(5)
    rows = [
        (f"v{min(rng.randrange(400), rng.randrange(400))}", str(i), None, "x" if i % 3 else "") for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    found = sorted(map(tuple, profile.top_values(df, df.columns, 5).collect()))
    expected = []
    for i, name in enumerate(df.columns):
        counts = {}
        for row in rows:
            if row[i] is not None:
                counts[row[i]] = counts.get(row[i], 0) + 1
        best = sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:5]
        expected += [(name, r + 1, v, n) for r, (v, n) in enumerate(best)]
    assert found == sorted(expected)


def test_keys_are_counted_without_a_join(tables, monkeypatch):
    seen, look = [], stored_layout.has_hot_key

    def counted(df, key, buckets):
        seen.append(plan_text(df))
        return look(df, key, buckets)

    monkeypatch.setattr(stored_layout, "has_hot_key", counted)
    stored_layout.store_tables(tables, 4)
    assert len(seen) == 6 and not any("Join" in text for text in seen)
