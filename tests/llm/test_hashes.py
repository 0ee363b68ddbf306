"""Words that a hash modulo a power of two cannot tell apart, in every operator."""

import numpy as np
import pytest
from loanloom.llm import arrays, context_tree, minhash, quality, suffix_dedup, toxicity

from .samples import documents
from .test_suffix_dedup import by_hand


def thue_morse(n, zero="a", one="b"):
    return "".join(one if bin(i).count("1") % 2 else zero for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 2048, 4096)]


@pytest.mark.parametrize("seed", [1, 2, 3, 7, 8])
def test_ranges_of_a_word_and_its_complement(seed):
    for word, other in PAIRS:
        data = np.frombuffer((word + "." + other + "." + word).encode(), np.uint8)
        hashes = arrays.PrefixHash(data, arrays.byte_table(seed, True))
        n = len(word)
        a, b, c = hashes.ranges(np.array([0, n + 1, 2 * n + 2]), np.array([n, 2 * n + 1, 3 * n + 2]))
        assert a == c != b


def test_windows_are_ranges():
    data = np.random.default_rng(2).integers(0, 3, 500).astype(np.uint8)
    hashes = arrays.PrefixHash(data, arrays.byte_table(4, False))
    at = np.arange(len(data) - 31)
    assert (hashes.windows(32) == hashes.ranges(at, at + 32)).all()
    assert len(np.unique(hashes.windows(32))) == len({data[i : i + 32].tobytes() for i in at})
    assert len(hashes.windows(501)) == 0


def test_near_duplicates_keep_both(spark):
    values = [w for pair in PAIRS for w in pair]
    found = minhash.near_duplicates(documents(spark, values)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(i, i, True) for i in range(len(values))]


def test_lines_and_words_differ(spark):
    word, other = PAIRS[0]
    values = ["\n".join(p) for p in PAIRS] + [f"{word}\n{word}", f"{word} x y {other} x y"]
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    found = quality.judge(documents(spark, values), labels).collect()
    assert sorted((r.doc_id, r.n_dup_lines, r.n_repeat_words) for r in found) == [
        (0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0),
    ]


def test_repeats_by_brute_force(spark):
    values = [w for pair in PAIRS[:2] for w in pair]
    found = suffix_dedup.remove_repeats(documents(spark, values)).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=repr)
    assert got == by_hand(list(enumerate(values)))


def test_unknown_words_stay_unknown(spark):
    for word, other in PAIRS:
        df = documents(spark, [word, word, word, other])
        known = {r.doc_id: r.n_known for r in context_tree.score(df).collect()}
        held = {r.doc_id: r.held_out for r in context_tree.score(df).collect()}
        trained = {i for i, h in held.items() if not h}
        for i, n in known.items():
            same = {j for j in trained if (j == 3) == (i == 3)}
            assert n == 1 + bool(same)


def test_features_differ():
    keys = []
    for word in PAIRS[0]:
        data = np.frombuffer(word.encode(), np.uint8)
        keys.append(arrays.PrefixHash(data, toxicity._TABLE).ranges(np.array([0]), np.array([len(word)]))[0])
    assert keys[0] != keys[1]
