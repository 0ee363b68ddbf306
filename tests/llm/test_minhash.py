import random
import re
from itertools import combinations

import numpy as np
import pytest
from loanloom.llm import minhash
from loanloom.llm.components import components
from loanloom.llm.queries import QUERIES
from loanloom.llm.scratch import Scratch

from .samples import DOCUMENTS, documents, empty_documents, hard_documents, prose

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_hand(rows):
    """Components by brute force, without any signature."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(k)
    near = {p for h in holders.values() for p in combinations(h, 2)}
    for x, y in near:
        (i, a), (j, b) = sets[x], sets[y]
        if 100 * len(a & b) >= 75 * len(a | b):
            i, j = sorted((root(i), root(j)))
            parent[j] = i
    out = []
    for i, s in sets:
        c = None if i is None else root(i)
        out.append((i, len(s), c, i is None or c == i))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, minhash.near_duplicates(df).collect()), key=repr)


def edit(text, rng, share):
    words = text.split()
    for k in rng.sample(range(len(words)), int(len(words) * share)):
        words[k] = f"edit{rng.randint(0, 9)}"
    return " ".join(words)


def test_samples(spark):
    df = hard_documents(spark)
    assert found(df) == by_hand([(r.doc_id, r.text) for r in df.collect()])
    assert found(empty_documents(spark)) == []
    assert all(r.kept for r in minhash.near_duplicates(documents(spark, [None, "", " "])).collect())


def test_chains_and_many_near_copies(spark, monkeypatch):
    """Groups whose members are similar to some but not all others, split into
    several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    values = []
    for seed in range(4):
        text = prose(100 + seed, 120)
        for _ in range(25):
            text = edit(text, rng, 0.02)
            values.append(text)
        values += [edit(values[-1], rng, s) for s in (0.01, 0.03, 0.05, 0.1)]
        values += [prose(500 + seed, n) for n in (3, 5, 8, 20)]
        values += [edit(values[-1], rng, 0.05) for _ in range(3)]
    values += values[:20]
    rng.shuffle(values)
    expected = by_hand(list(enumerate(values)))
    assert found(documents(spark, values)) == expected
    assert 3 < len({c for _, _, c, _ in expected}) < len(values) - 20


def test_rows_with_equal_ids(spark):
    a, b = prose(1, 200), prose(2, 200)
    rows = [(1, a), (2, a), (2, a), (2, b), (3, b), (4, None)]
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCUMENTS)
    assert found(df) == [
        (1, 196, 1, True),
        (2, 196, 1, False),
        (2, 196, 1, False),
        (2, 196, 2, True),
        (3, 196, 2, False),
        (4, 0, 4, True),
    ]


def test_estimates_are_close():
    rng = np.random.default_rng(3)
    for n, common in ((2000, 1700), (400, 300), (3000, 600)):
        shared = rng.integers(0, 1 << 63, common, dtype=np.uint64) * np.uint64(2)
        sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, n - common, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in range(2)]
        r = minhash.registers(sets)
        size = np.array([len(sets[0])])
        est = minhash.estimates(r[:1], r[1:], size, np.array([len(sets[1])]))[0]
        true = common / (2 * n - common)
        assert abs(est - true) < 4 * (true * (1 - true) / 128) ** 0.5 + 0.01
    assert 0 < minhash.chance(1000, 1000) < 0.01


def test_common_counts(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 120)).astype(np.uint64)) for _ in range(30)]
    found = minhash.common_counts(sets[:12], sets[5:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:12]]


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)]
    edges += [(2000 + rng.randint(0, 60), 2000 + rng.randint(0, 60)) for _ in range(40)]
    rng.shuffle(edges)
    parent = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    got = components(df, Scratch(spark, "test-components"), "c").collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent}
    assert len(got) == len(parent)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op1_near_duplicates"](spark, folder).collect()), key=repr)
    assert got == by_hand(rows)
