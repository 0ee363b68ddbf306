import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from loanloom.llm import context_tree as ct
from loanloom.llm.queries import QUERIES

from .samples import documents, empty_documents, hard_documents, prose

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOW))


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Tree:
    """Context-tree weighting by dictionaries and recursion."""

    def __init__(self, texts):
        self.counts = {}
        for t in texts:
            data = b"\n" * ct.DEPTH + " ".join(tokens(t)).encode() + b"\n"
            for i in range(ct.DEPTH, len(data)):
                for bit in range(8):
                    prefix, taken = (1 << bit) | data[i] >> (8 - bit), data[i] >> (7 - bit) & 1
                    for d in range(ct.DEPTH + 1):
                        self.counts.setdefault((data[i - d : i], prefix), [0, 0])[taken] += 1
        self.children = {}
        for context, prefix in self.counts:
            if context:
                self.children.setdefault((context[1:], prefix), []).append((context, prefix))
        self.memo = {}

    def kt(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, node):
        if node not in self.memo:
            own = self.kt(node)
            if len(node[0]) == ct.DEPTH:
                self.memo[node] = own
            else:
                below = sum(self.weighted(c) for c in self.children[node])
                self.memo[node] = np.logaddexp(own, below) - math.log(2)
        return self.memo[node]

    def bit(self, context, prefix, taken, depth=0):
        node = (context[ct.DEPTH - depth :], prefix)
        counts = self.counts.get(node, [0, 0])
        own = (counts[taken] + 0.5) / (sum(counts) + 1)
        if depth == ct.DEPTH or (context[ct.DEPTH - depth - 1 :], prefix) not in self.counts:
            return own
        share = math.exp(self.kt(node) - math.log(2) - self.weighted(node))
        return share * own + (1 - share) * self.bit(context, prefix, taken, depth + 1)

    def byte(self, context, value):
        return sum(
            math.log10(self.bit(context, (1 << b) | value >> (8 - b), value >> (7 - b) & 1)) for b in range(8)
        )

    def score(self, text):
        data = b"\n" * ct.DEPTH + " ".join(tokens(text)).encode() + b"\n"
        return sum(self.byte(data[i - ct.DEPTH : i], data[i]) for i in range(ct.DEPTH, len(data)))


def by_hand(rows):
    training = [t for i, t in rows if not held(i)]
    counts = Counter()
    for t in training:
        counts.update(tokens(t))
        counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    tree = Tree(training)
    out = []
    for i, t in rows:
        words = [*tokens(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), n, base, tree.score(t)))
    return out


def same(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    found = sorted((tuple(r)[:7] for r in found), key=key)
    expected = sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for f, e in zip(found, expected, strict=True):
        assert f[5] == pytest.approx(e[5], abs=1e-5) and f[6] == pytest.approx(e[6], abs=1e-4)


def small(df):
    return df.where("length(text) < 3000 OR text IS NULL")


@pytest.mark.parametrize("top", [1 << 19, 40])
def test_scores_against_brute_force(spark, top):
    df = small(hard_documents(spark))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert any(held(i) for i, _ in rows)
    same(ct.score(df, top_words=top, top_grams=top).collect(), by_hand(rows))


def test_bytes_of_a_context_add_up_to_one(spark):
    tree = Tree([prose(1, 50)])
    for context in (b"\n\n\n\n\n", b"th on", b"zzzzz"):
        assert sum(10 ** tree.byte(context, v) for v in range(256)) == pytest.approx(1)


def test_empty_and_untrained(spark):
    assert ct.score(empty_documents(spark)).collect() == []
    only = documents(spark, [prose(i, 30) for i in range(40)]).where("crc32(cast(doc_id as string)) % 7 = 2")
    rows = ct.score(only).collect()
    assert rows and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert all(r.score == pytest.approx(r.n_bytes * math.log10(1 / 256)) for r in rows)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7, 15.5, 16, 1000.5, 1e8])
    assert np.allclose(ct._lgamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def test_query_beats_its_baseline_on_held_out_texts(spark):
    found = QUERIES["op7_context_tree"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    assert len(found) > 1000
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
