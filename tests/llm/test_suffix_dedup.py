import hashlib
import random

import numpy as np
import pytest
from loanloom.llm import induced_sort, suffix_dedup
from loanloom.llm.queries import QUERIES

from .samples import DOCUMENTS, documents, empty_documents, hard_documents, prose, texts

L = suffix_dedup.LENGTH


def check_order(characters):
    text = np.array(characters, np.int16)
    positions, lcps = [], []
    for p, c in induced_sort.SuffixOrder(text).ascending():
        positions += p.tolist()
        lcps += c.tolist()
    assert sorted(positions) == list(range(len(text)))
    suffixes = [tuple(characters[p : p + L]) for p in positions]
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        assert a <= b
        common = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcps[i] == common


@pytest.mark.parametrize(("step", "held"), [(1 << 16, 48 << 20), (7, 64)])
def test_suffix_order(monkeypatch, step, held):
    """Also with tiny steps and all queues on disk."""
    monkeypatch.setattr(induced_sort, "STEP", step)
    monkeypatch.setattr(induced_sort, "HELD_BYTES", held)
    rng = random.Random(1)
    for _ in range(100):
        n, most = rng.randint(1, 250), rng.choice([1, 2, 26, 256])
        check_order([rng.randint(0, most) for _ in range(n)])
    base = [rng.randint(1, 20) for _ in range(150)]
    check_order(base * 4 + [0] + base[20:] + [0] + base * 2 + [0])
    check_order([5] * 500 + [0] + [5] * 300)


def by_hand(rows):
    """Removes repeated strings with a dictionary of all of them."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - L + 1):
            s = data[i : i + L]
            if s in seen:
                gone[i : i + L] = b"\1" * L
            seen.setdefault(s, (doc, i))
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc, text] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return sorted(((r[0], *out[r]) for r in rows), key=repr)


def found(df, **options):
    rows = suffix_dedup.remove_repeats(df, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=repr)


def test_samples(spark):
    df = hard_documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert found(df) == by_hand(rows)
    for r in suffix_dedup.remove_repeats(df, keep=["lang", "score"]).collect():
        assert len(r.spans) == 2 * r.n_spans and r.lang in (None, "en") and r.score in (None, "clash")
        assert r.n_bytes - r.n_removed >= len(r.kept_text.encode())
    assert found(empty_documents(spark)) == []
    assert found(documents(spark, [None, "", "short"])) == by_hand([(0, None), (1, ""), (2, "short")])


def test_many_shared_passages(spark, monkeypatch):
    rng = random.Random(6)
    passages = [prose(700 + i, rng.randint(15, 80)) for i in range(12)]
    line = "The and attion to thanedble the, anea. Eriner thanea.\n"
    values = []
    for i in range(120):
        parts = [prose(800 + i, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : rng.randint(a, len(p))], prose(2000 + rng.randint(0, 10**6), rng.randint(0, 30))]
        values.append(line * rng.randint(0, 1) + "".join(parts))
    values += ["ab" * rng.randint(40, 200) for _ in range(5)] + ["z" * rng.randint(90, 400) for _ in range(5)]
    values += [(prose(1, 6) * 40)[: rng.randint(100, 900)] for _ in range(5)] + values[:10]
    values += ["x" + "=" * 77 + "y" + "=" * 77 + "z" + "=" * 99, prose(3, 4) * 3, "é" * 150]
    rng.shuffle(values)
    df = documents(spark, values).repartition(5)
    expected = by_hand(list(enumerate(values)))
    assert sum(e[2] for e in expected) > 10_000
    assert found(df) == expected
    # the choice of common grams does not matter, nor does the size of a part
    monkeypatch.setattr(suffix_dedup, "COMMON_SHARE", 0.0)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 2000)
    assert found(df, sample_docs=40) == expected


def test_large_keys_are_spread(spark, monkeypatch):
    """No task sorts more of one key than the bound, whatever the sample of
    common grams has missed, and the result is the same in small batches."""
    bound = 2000
    monkeypatch.setattr(suffix_dedup, "KEY_BYTES", bound, raising=False)
    monkeypatch.setattr(suffix_dedup, "COMMON_SHARE", 2.0)
    sizes, sort = [], suffix_dedup._sorted_repeats

    def measured(shards):
        rows = shards.selectExpr("key", "doc", "start", "length(content) AS n").distinct()
        sizes.extend(r[1] for r in rows.groupBy("key").sum("n").collect())
        return sort(shards)

    monkeypatch.setattr(suffix_dedup, "_sorted_repeats", measured)
    line = "The and attion to thanedble the, anea. Eriner thanea.\n"
    passage = prose(50, 40)
    values = [prose(3000 + i, 12) + line + prose(4000 + i, 12) + passage[: 40 + 5 * i] for i in range(60)]
    values += ["z" * 900, "ab" * 400, values[3], "z" * 300 + values[5]]
    rows = [(i, v) for i, v in enumerate(values)] + [(7, values[7])] * 3
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCUMENTS).repartition(4)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        assert found(df) == by_hand(rows)
    finally:
        spark.conf.set(batch, before)
    assert sizes and max(sizes) <= bound


def test_rows_with_equal_ids(spark):
    a, b = prose(1, 100), prose(2, 100)
    rows = [(1, a), (1, a), (2, a), (None, b), (3, b)]
    df = spark.createDataFrame([(*r, *[None] * 6) for r in rows], DOCUMENTS)
    assert found(df) == by_hand(rows)
    clash = spark.createDataFrame([(*r, *[None] * 6) for r in [(1, a), (1, b + a), (2, a), (2, a)]], DOCUMENTS)
    rows = suffix_dedup.remove_repeats(clash).collect()
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id == 2)
    assert sum(r.n_removed >= len(a.encode()) for r in rows if r.doc_id == 1) == 1


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op3_suffix_dedup"](spark, folder).collect()), key=repr)
    assert got == by_hand(rows)
    assert len(texts()) and sum(r[2] for r in got) > 0
