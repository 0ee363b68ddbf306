import itertools
import math
import random

import numpy as np
import pytest
from loanloom.llm import hilbert
from loanloom.llm.queries import QUERIES
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, node string, first string, slot string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def brute_force(rows, asks, k, width):
    """{(query id, its vector): [(score, id), ...]} over distinct rows."""
    kept = {
        (i, tuple(v))
        for i, v in rows
        if i is not None
        and v is not None
        and len(v) == width
        and all(x is not None and math.isfinite(x) for x in v)
        and any(v)
    }
    out = {}
    for i, v in kept:
        if asks(i):
            near = [(math.dist(v, w), j) for j, w in kept if (j, w) != (i, v)]
            out[i, v] = sorted(near)[:k]
    return out


def lists_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in out.items()}


def clustered(n, width=16, centers=40, seed=5):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 5) for _ in range(width)] for _ in range(centers)]
    return [(i, [m + rng.gauss(0, 0.5) for m in middles[i % centers]]) for i in range(n)]


@pytest.mark.parametrize(("dims", "bits"), [(1, 5), (2, 4), (3, 3), (4, 2), (5, 1)])
def test_curve_visits_every_cell_by_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    numbers = hilbert.hilbert_numbers(cells, bits)
    assert sorted(numbers.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(numbers)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_blocks_part_crowded_cells():
    numbers = np.array([[7] * 900 + [9] * 100], np.uint64)
    ties = hilbert.tie_breaks(np.arange(1000))
    blocks = hilbert.Blocks.fit(numbers, ties, 10)
    sizes = np.bincount(blocks.find(numbers, ties)[0], minlength=10)
    assert sizes.min() >= 99 and sizes.max() <= 101


def check_exact(found, expected):
    by_id = {}
    for (i, _), near in expected.items():
        by_id.setdefault(i, []).append(near)
    assert set(found) == {i for i, lists in by_id.items() if any(lists)}
    for i, got in found.items():
        # an id that asks with two vectors has two lists
        assert sorted(r[0] for r in got) == sorted(
            n + 1 for near in by_id[i] for n in range(len(near))
        )
        assert sorted((round(s, 9), j) for _, j, s in got) == sorted(
            (round(s, 9), j) for near in by_id[i] for s, j in near
        )
        if len(by_id[i]) == 1:
            assert [j for _, j, _ in got] == [j for _, j in by_id[i][0]]


def test_exact_in_one_block_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    same = [0.25] * 6
    rows += [(1000 + i, same) for i in range(80)]
    rows += [
        (200, None),
        (300, []),
        (400, [0.0] * 6),
        (400, [-0.0] * 6),
        (500, [1.0] * 5),
        (600, [*same[:5], None]),
        (700, [*same[:5], float("nan")]),
        (800, [*same[:5], float("inf")]),
        (None, same),
        (0, rows[0][1]),  # a repeated row
        (10, [3.0] * 6),  # an id with two vectors
        (2000, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]),  # ties between different vectors
        *((2001 + i, [1.0 + s * 0.5, 0.0, 0.0, 0.0, 0.0, 0.0]) for i, s in enumerate([1, -1] * 3)),
        (2010, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0]),
        (2011, [1.0, 0.0, -0.5, 0.0, 0.0, 0.0]),
    ]
    found = hilbert.search(frame(spark, rows).repartition(4), F.col("vec_id") % 10 == 0, k=5)
    check_exact(lists_of(found), brute_force(rows, lambda i: i % 10 == 0, 5, 6))


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0])]
    found = hilbert.search(frame(spark, rows), F.col("vec_id") % 100 == 0)
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 1.0)]
    for none in ([], [(1, None)], [(0, [0.0, 0.0])], [(0, [1.0])], [(7, [1.0, 2.0])]):
        df = hilbert.search(frame(spark, none), F.col("vec_id") % 100 == 0)
        assert df.collect() == []
        assert df.columns == ["query_id", "rank", "vec_id", "score"]


def recall(found, expected, k):
    hits = total = 0
    for (i, _), near in expected.items():
        limit = near[-1][0] + 1e-9
        hits += sum(s <= limit for _, _, s in found.get(i, []))
        total += len(near)
    return hits / total


def test_windows_find_most_neighbours(spark):
    rows = clustered(3000)
    rows += [(5000 + i, rows[1][1]) for i in range(700)]  # one vector many times
    df = frame(spark, rows).repartition(6)
    found = lists_of(hilbert.search(df, F.col("vec_id") % 20 == 0, k=5, block_rows=32))
    expected = brute_force(rows, lambda i: i % 20 == 0, 5, 16)
    assert recall(found, expected, 5) >= 0.9
    assert all([r[0] for r in got] == [1, 2, 3, 4, 5] for got in found.values())
    # equal vectors are met whatever the windows, smallest ids first
    assert [(j, s) for _, j, s in found[5000]] == [(1, 0.0), *((5001 + i, 0.0) for i in range(4))]


def test_narrow_windows_where_vectors_are_clustered(spark):
    df = frame(spark, clustered(4000)).repartition(6)
    rows = df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    classes = hilbert._classes(rows, 5).cache()
    seekers = classes.where("first % 20 = 0")
    index = hilbert.fit(classes, seekers, 16, 5, 0.95, block_rows=32)
    met = len(index.curves.directions) * (2 * index.window + 1) / index.blocks.count
    assert index.recall >= 0.95 and met < 0.6
    classes.unpersist()


def test_query_over_the_whole_table(spark, sf_dir):
    for folder in (sf_dir, "/root/testdata/sf0.1"):
        table = spark.read.parquet(f"{folder}/embeddings.parquet")
        rows = [(r.vec_id, r.embedding) for r in table.collect()]
        expected = brute_force(rows, lambda i: i % 100 == 0, 10, 64)
        found = lists_of(QUERIES["op12_hilbert_search"](spark, folder))
        assert set(found) == {i for i, _ in expected}
        assert recall(found, expected, 10) >= 0.9
