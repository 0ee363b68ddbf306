import zlib

import corpus_pipeline as cp
import numpy as np
from loanloom.llm.queries import table
from loanloom.llm.tokens import tokenizer

from . import test_filters, test_minhash, test_suffix_dedup
from .samples import DOCUMENTS, hard_documents, prose, texts
from .test_tokens import check_packing


def test_stages_against_brute_force(spark):
    """Each stage against a plain version of it, on what the one before kept."""
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}

    # quality: the base rules, and a score that parts the labelled documents
    kept = cp.quality_rules(spark, docs, folder).cache()
    texts_ = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == docs.columns
    for doc, text in texts_.items():
        assert text == rows[doc].text
    for doc, r in rows.items():
        base = test_filters.base_by_hand(r.text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert not (failed and doc in texts_)
        if not failed and doc in labels:
            assert (doc in texts_) == bool(labels[doc])

    # near duplicates
    groups = test_minhash.by_hand(list(texts_.items()))
    unique = cp.near_dedup(spark, kept, folder).cache()
    texts_ = {r.doc_id: r.text for r in unique.collect()}
    assert set(texts_) == {i for i, _, _, stays in groups if stays}

    # repeated passages
    expected = {r[0]: r for r in test_suffix_dedup.by_hand(list(texts_.items()))}
    found = cp.remove_repeats(spark, unique, folder).cache()
    left = {r.doc_id: r for r in found.collect()}
    for doc, r in left.items():
        n_bytes, removed = expected[doc][1:3]
        assert n_bytes - removed - 6 * expected[doc][3] <= len(r.text.encode()) <= n_bytes - removed
        assert r.n_chars == len(r.text)
    assert all(e[2] == e[1] for doc, e in expected.items() if doc not in left)

    # benchmark
    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    clean = cp.decontaminate_texts(spark, found, folder).cache()
    after = {r.doc_id: r.text for r in clean.collect()}
    for doc, r in left.items():
        n, hit, _ = test_filters.hits_by_hand(r.text, items)
        assert (doc in after) == (hit <= cp.MOST_HIT * n)
        if doc in after and not hit:
            assert after[doc] == r.text
        elif doc in after:
            assert len(after[doc]) < len(r.text)

    # packing
    tok = tokenizer(cp.BYTE_BPE)
    ids = {doc: [*tok.encode(t, add_special_tokens=False).ids, 1] for doc, t in after.items()}
    check_packing(cp.pack(spark, clean, folder).collect(), ids, 2048)
    whole = cp.run(spark, folder).collect()
    check_packing(whole, ids, 2048)
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) for r in whole)


def test_hard_rows_pass_all_stages(spark):
    folder = "/root/testdata/sf0.001"
    for docs in (hard_documents(spark), hard_documents(spark).where("false")):
        for name, stage in cp.STAGES:
            docs = stage(spark, docs, folder).cache()
            if name != "pack":
                assert docs.columns == cp.COLUMNS


def test_one_row_of_a_group_stays_whatever_its_id(spark):
    """A third of the rows under one id, copies without an id, and equal rows."""
    a, b, c, d = (prose(4000 + i, 150) for i in range(4))
    near = a.replace(a.split(" ")[70], "other", 1)
    values = [(7, a)] * 5 + [(7, b), (3, near), (None, a), (None, c), (None, c), (9, b), (4, d), (8, d), (5, None), (6, "")]
    docs = spark.createDataFrame([(*v, "en", "s", 1, None, None, None) for v in values], DOCUMENTS)
    for parts in (1, 4):
        kept = cp.near_dedup(spark, docs.repartition(parts), "").collect()
        got = sorted(((r.doc_id, r.text) for r in kept), key=repr)
        assert got == sorted([(3, near), (7, b), (None, c), (4, d), (5, None), (6, "")], key=repr)


def test_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(i, prose(3000 + i, 200), "en", "s", 1, None, None, None) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for stage in (cp.near_dedup, cp.remove_repeats, cp.decontaminate_texts):
        docs = stage(spark, docs, folder).cache()
    assert {r.doc_id: r.text for r in docs.collect()} == {r[0]: r[1] for r in rows}
    assert len(texts())
