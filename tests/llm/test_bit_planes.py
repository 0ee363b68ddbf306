import hashlib
import math
import random

import numpy as np
from loanloom.llm import bit_planes
from loanloom.llm.queries import QUERIES, SQL
from loanloom.llm.vectors import usable
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, cluster string, id string, planes string, distance string"


def brute_force(rows, k=16, rounds=3, scale=64):
    kept = []
    for name, v in rows:
        if v is None or len(v) != 64 or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((name, [math.floor(scale * x) if abs(x) < 2**40 else int(x) * scale for x in v]))

    def order(row):
        return hashlib.sha256(f"1:{row[0]}".encode()).hexdigest()

    centroids = [v for _, v in sorted((r for r in kept if r[0] is not None), key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, vs in groups.items():
            centroids[i] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(name, *nearest(v)) for name, v in kept]
    inertia = sum(d for _, d, _ in found)
    by = {}
    for _, d, c in found:
        by[c] = by.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    most = 2**63 - 1
    fit = [(d, by[c], inertia) for _, d, c in found]
    fit = [[v if v <= most else None for v in row] for row in fit]
    return sorted(
        ((str(n), c, *f, sha[c]) for (n, d, c), f in zip(found, fit, strict=True)), key=str
    )


def samples(n, seed=1, size=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(i % 5, 1) * size for _ in range(64)]) for i in range(n)]


def rows_of(df):
    rows = df.collect()
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(((str(r.vec_id), *(r[n] for n in names)) for r in rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def test_against_brute_force_with_odd_rows(spark):
    rows = samples(200)
    odd = [0.5] * 64
    rows += [
        (900, None),
        (901, []),
        (902, odd[:63]),
        (903, [*odd, 0.5]),
        (904, [*odd[:63], None]),
        (905, [*odd[:63], float("nan")]),
        (906, [*odd[:63], float("-inf")]),
        (907, [0.0] * 64),
        (None, odd),
        (5, rows[5][1]),  # a repeated row
        (908, [-1e-9] * 64),
        *((1000 + i, odd) for i in range(150)),  # one vector many times
    ]
    found = bit_planes.cluster(frame(spark, rows).repartition(5))
    assert rows_of(found) == brute_force(rows)


def test_few_and_no_vectors(spark):
    rows = samples(3)
    assert rows_of(bit_planes.cluster(frame(spark, rows))) == brute_force(rows)
    for none in ([], [(1, None)], [(None, [0.5] * 64)]):
        assert bit_planes.cluster(frame(spark, none)).collect() == []


def test_numbers_beyond_64_bits(spark):
    rows = samples(40, 2) + [(i + 100, v) for i, v in samples(8, 3, 1e8)]
    assert rows_of(bit_planes.cluster(frame(spark, rows))) == brute_force(rows)
    huge = rows[:30] + [(200, [1e14] * 64), (201, [-1.7e13] * 64)]
    assert rows_of(bit_planes.cluster(frame(spark, huge))) == brute_force(huge)


def test_planes_give_exact_products():
    rng = np.random.default_rng(4)
    for size in (1, 40, 5000, 1 << 26):
        a = rng.integers(-size, size + 1, (30, 64))
        b = rng.integers(-size, size + 1, (7, 64))
        assert (bit_planes.products(bit_planes.pack(a), bit_planes.pack(b)) == a @ b.T).all()
        assert (bit_planes.squares(bit_planes.pack(a)) == (a * a).sum(axis=1)).all()
        at = rng.integers(0, 4, 30)
        sums = bit_planes.bit_sums(bit_planes.pack(a), at, 4)
        assert all((sums[c] == a[at == c].sum(axis=0)).all() for c in range(4))


def test_query_over_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = QUERIES["op13_bit_planes"](spark, sf_dir)
    assert rows_of(found) == brute_force(rows)
    assert "op13_bit_planes" in SQL
    assert table.where(usable(F.col("embedding"))).count() == len(rows)
