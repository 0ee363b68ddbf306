import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from loanloom.llm import keyed_ids, packing, token_counts
from loanloom.llm.queries import BYTE_BPE, WORD_BPE
from loanloom.llm.scratch import Scratch
from loanloom.llm.tokens import PieceEncoder, tokenizer

from .samples import documents, empty_documents, hard_documents, prose, texts


def odd_texts(n):
    rng = random.Random(3)
    parts = ["a", "Bé", " ", "  ", "\n", "\t", "'s", "'ll", "12", "<|endoftext|>", "\xa0", "\x1c", "é",
             "\u0301", "ﬁ", "Ⅷ", "😀", "日本", "\r\n", "<|startoftext|>", "İ", "Σ", "\x85", "\u2028", "%%", "_", ".", ",", "|", "'", "3.14", "=\u0338", "word,", "x&&&", "!!", ".\u0301", "ß;", "日.", "J\u030c", "THE", "\u212a"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize(("path", "keeps_space"), [(BYTE_BPE, True), (WORD_BPE, False)])
def test_piece_encoder_equals_the_library(path, keeps_space):
    encoder, tok = PieceEncoder(path, keeps_space), tokenizer(path)
    values = [t or "" for t in texts()] + odd_texts(3000)
    for text, ids in zip(values, encoder.encode(values), strict=True):
        expected = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text


def test_long_texts_are_spliced_exactly():
    tok = tokenizer(BYTE_BPE)
    rng = random.Random(1)
    values = [prose(9, 5000), " " * 3000 + "a" * 3000, "ab" * 4000, "\n \n" * 2000 + "x", "é" * 3000]
    values += ["".join(rng.choices(odd_texts(50), k=300)) for _ in range(20)]
    values += [("<|endoftext|>" * 300), ("word " * 50 + " " * 400) * 10]
    for text in values:
        expected = len(tok.encode(text, add_special_tokens=False).ids)
        for piece, overlap in ((700, 80), (1500, 128), (400, 96)):
            assert token_counts.count_long(tok, text, piece, overlap) == expected


def test_token_counts(spark):
    df = hard_documents(spark)
    found = token_counts.count_tokens(df, BYTE_BPE, piece_chars=2000).collect()
    tok = tokenizer(BYTE_BPE)
    expected = sorted(
        (r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(tok.encode(r.text or "", add_special_tokens=False).ids))
        for r in df.collect()
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == expected
    assert token_counts.count_tokens(empty_documents(spark), BYTE_BPE).collect() == []


def check_packing(rows, ids_of, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0 and at < capacity


def test_packing(spark):
    tok = tokenizer(BYTE_BPE)
    df = documents(spark).repartition(2)
    ids = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 1] for r in df.collect()}
    check_packing(packing.pack(df, BYTE_BPE, 1).collect(), ids, 2048)
    check_packing(packing.pack(df, BYTE_BPE, 1, capacity=96).collect(), ids, 96)
    assert packing.pack(empty_documents(spark), BYTE_BPE, 1).collect() == []
    hard = packing.pack(hard_documents(spark), BYTE_BPE, 1, with_ids=True).collect()
    assert sum(r.length for r in hard if r.doc_id == 1) == 2 * len(ids[1])
    assert all(len(r.ids) == 4 * r.length for r in hard)


def best_sum(counts, capacity):
    """Brute force: the largest sum with the longest length in it."""
    seed = max(counts)
    sums = {seed}
    for length, n in counts.items():
        for _ in range(n - (length == seed)):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


def test_best_fill_is_best():
    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randint(1, 60): rng.randint(1, 3) for _ in range(rng.randint(1, 7))}
        chosen = packing.best_fill(counts, sorted(counts), 64)
        assert all(counts[l] >= c for l, c in chosen.items())
        assert sum(l * c for l, c in chosen.items()) == best_sum(counts, 64)


def test_keyed_ids_round_trip(spark):
    tok = tokenizer(WORD_BPE)
    df = hard_documents(spark)
    folder = Scratch(spark, "test-ids").folder
    keyed_ids.write_ids(df, folder, WORD_BPE, 2, shards=3)
    rows = [
        (r.doc_id, r.text, [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in df.collect()
    ]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(keyed_ids.read_ids(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    at = 0
    for (doc, _, ids), r in zip(rows, found, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (doc, at, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.ids_crc32 == zlib.crc32(r.ids)
        at += len(ids)
    keys = spark.createDataFrame([(3,), (999,), (None,), (13,), (-5,)], "doc_id long")
    looked = {r.doc_id: r.ids for r in keyed_ids.lookup_ids(keys, folder).collect()}
    expected = {d: i for d, _, i in rows}
    assert looked[999] is None and looked[None] is None and looked[-5] is None
    for key in (3, 13):
        assert np.frombuffer(looked[key], "<u4").tolist() == expected[key]


def test_keys_that_own_many_rows_span_shards(spark):
    """Half of the rows without an id or under one; all come back."""
    values = [(None if i % 4 == 0 else 500 if i % 4 == 1 else i, f"text {i} " * (i % 5)) for i in range(800)]
    df = spark.createDataFrame(values, "doc_id long, text string").repartition(4)
    folder = Scratch(spark, "test-ids").folder
    manifest = keyed_ids.write_ids(df, folder, WORD_BPE, 2, shards=8).collect()
    assert max(r.n_docs for r in manifest) <= 200
    found = sorted(keyed_ids.read_ids(spark, folder).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in found]
    assert ids == sorted([v for v, _ in values], key=lambda v: (v is not None, v or 0))
    assert [r.start for r in found[1:]] == np.cumsum([r.n_tokens for r in found])[:-1].tolist()
    tok = tokenizer(WORD_BPE)
    lengths = sorted(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in values)
    assert sorted(r.n_tokens for r in found) == lengths
    keys = spark.createDataFrame([(500,), (3,)], "doc_id long")
    assert all(r.ids is not None for r in keyed_ids.lookup_ids(keys, folder).collect())


def test_folders_are_qualified_by_the_session(spark, tmp_path):
    plain, schemed = str(tmp_path / "a"), f"file://{tmp_path}/b"
    assert keyed_ids.qualified(spark, plain) == f"file:{plain}"
    for folder in (plain, schemed, f"file:{tmp_path}/c"):
        keyed_ids.write_ids(documents(spark), folder, WORD_BPE, 2, shards=2)
        assert keyed_ids.read_ids(spark, folder).count() == len(texts())
    assert {p.name for p in tmp_path.iterdir()} == {"a", "b", "c"}


def test_store_goes_with_the_session(spark):
    scratch = Scratch(spark, "test-ids")
    files, place = scratch._place("store")
    scratch.path("store")
    assert files.cancelDeleteOnExit(place)


def test_keyed_ids_empty(spark):
    folder = Scratch(spark, "test-ids").folder
    keyed_ids.write_ids(empty_documents(spark), folder, WORD_BPE, 2, shards=2)
    assert keyed_ids.read_ids(spark, folder).collect() == []


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = np.arange(-5000, 15000, dtype=np.int64) * 7
    order = np.zeros(len(keys), np.int64)
    n = np.arange(len(keys)) % 9 + 1
    data = keyed_ids.index_bytes(keys, np.cumsum(n) - n, n, 0)
    index = keyed_ids.Index(data)
    at, found = index.find(keys, order)
    assert (at == np.cumsum(n) - n).all() and (found == n).all()
    absent, _ = index.find(keys + 1, order)
    assert (absent == -1).mean() > 0.999
    h = keyed_ids.hashed(keys, order, index.seed)
    assert sorted(index._hash.slots(h).tolist()) == list(range(len(keys)))


def test_known_words_are_not_encoded_again(monkeypatch):
    texts = [
        "the dog's  bone, it's 12 o'clock;\n\n x=3.5%\t",
        " <|endoftext|> the dog \xa0 naïve “quoted” 日本語 the\r\n",
        "",
        " " * 9,
    ]
    tok = token_counts.tokenizer(BYTE_BPE)
    expected = [len(tok.encode(t, add_special_tokens=False)) for t in texts]
    assert token_counts.count_whole(BYTE_BPE, texts) == expected

    def again(self, pieces):
        raise AssertionError(f"encoded again: {pieces}")

    monkeypatch.setattr("loanloom.llm.tokens.PieceEncoder._encode_pieces", again)
    assert token_counts.count_whole(BYTE_BPE, texts + texts) == expected * 2
