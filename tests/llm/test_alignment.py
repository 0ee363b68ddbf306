import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from loanloom.llm import alignment
from loanloom.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES, table
from tokenizers import Tokenizer

from .samples import documents, empty_documents, hard_documents, prose
from .test_tokens import odd_texts


def byte_letters():
    """The usual map of byte-level BPE, by bytes."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, n = {}, 0
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(256 + n)] = b
            n += 1
    return out


A = Tokenizer.from_file(BYTE_BPE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
LETTERS = byte_letters()


def encoded(text):
    """[(id, start, end)] of A and of B in bytes; none without tokens."""
    if not text:
        return [], []
    e = A.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(LETTERS[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
    b = [
        (i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())
        for i in B.encode(text)
    ]
    data = (" " + text).encode()
    if b"".join(t for _, t in a) != data or b"".join(t for _, t in b) != data:
        return [], []
    out = []
    for tokens in (a, b):
        at, ranges = 0, []
        for i, t in tokens:
            ranges.append((i, at, at + len(t)))
            at += len(t)
        out.append(ranges)
    return out


def described(text):
    """(groups text, linked id pairs, overlaps, shared) by comparing ranges."""
    a, b = encoded(text)
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, shared = [], []
    i = j = 0
    for end in ends:
        x, y = [], []
        while i < len(a) and a[i][2] <= end:
            x.append(i)
            i += 1
        while j < len(b) and b[j][2] <= end:
            y.append(j)
            j += 1
        groups.append(",".join(str(a[k][0]) for k in x) + "|" + ",".join(str(b[k][0]) for k in y))
        shared += [(k, m) for k in x for m in y]
    where = {e: i for i, _, e in b}
    links = [(i, where[e]) for i, _, e in a if e in where]
    overlaps, first = [], 0
    for i, (_, s, e) in enumerate(a):
        while first < len(b) and b[first][2] <= s:
            first += 1
        j = first
        while j < len(b) and b[j][1] < e:
            overlaps.append((i, j, min(e, b[j][2]) - max(s, b[j][1])))
            j += 1
    return ";".join(groups), links, overlaps, shared, len(a), len(b)


def expected(rows):
    """Rows of the query by brute force."""
    found = [(r.doc_id, described(r.text)) for r in rows]
    count = Counter(pair for _, d in found for pair in d[1])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for doc, (groups, links, _, _, n_a, n_b) in found:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append(
            (
                str(doc),
                n_a,
                n_b,
                groups.count(";") + 1 if groups else 0,
                len(links),
                sum(count[p] == most[p[1]] for p in links),
                sum(count[p] for p in links),
                sha,
            )
        )
    return sorted(out)


def rows_of(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r.doc_id), *(r[n] for n in names)) for r in df.collect())


ODD = [
    "<s>a</s> <unk> <0x41> <|endoftext|>b",
    "a▁b c",
    "▁",
    " ",
    "  two  spaces ",
    "\n\n x\t\ty\r\nz;\r end",
    "\x00\x01 ctl",
    "naïve 😀日本語 ﬁ é",
    "word.\nnext,line!! 3.14",
]


def test_statistics_against_brute_force(spark):
    df = hard_documents(spark).unionAll(documents(spark, ODD))
    wanted = expected(df.collect())
    found = alignment.link_statistics(df.repartition(3), BYTE_BPE, PIECE_BPE)
    assert rows_of(found) == wanted
    # rare pairs through the join, small tables of blocks
    few = alignment.link_statistics(df, BYTE_BPE, PIECE_BPE, top_pairs=20, kept=50)
    assert rows_of(few) == wanted
    none = alignment.link_statistics(df, BYTE_BPE, PIECE_BPE, top_pairs=0)
    assert rows_of(none) == wanted


def test_empty_table(spark):
    assert alignment.link_statistics(empty_documents(spark), BYTE_BPE, PIECE_BPE).collect() == []
    only = documents(spark, [None, ""])
    assert {r[1:] for r in rows_of(alignment.link_statistics(only, BYTE_BPE, PIECE_BPE))} == {(0,) * 6 + ("",)}


def test_links_against_ranges(spark):
    values = [*ODD, *odd_texts(150), prose(4, 300)]
    found = alignment.align(documents(spark, values), BYTE_BPE, PIECE_BPE, with_links=True)
    for r in found.collect():
        groups, links, overlaps, shared, n_a, n_b = described(values[r.doc_id])
        assert (r.groups, r.n_a, r.n_b) == (groups, n_a, n_b)
        words = np.frombuffer(r.pairs, "<u4").tolist()
        assert [(w >> 16, w & 65535) for w in words] == links
        assert sorted((e.a, e.b, e.bytes) for e in r.overlaps) == sorted(overlaps)
        assert sorted((e.a, e.b) for e in r.shared) == sorted(shared)


def test_blocks_equal_whole_texts():
    both = alignment.Aligner(BYTE_BPE, PIECE_BPE, 100, False)
    assert both.b.cuts
    values = odd_texts(2000) + [prose(11, 500)]
    for i in range(0, len(values), 50):
        some = values[i : i + 50]
        for text, blocks in zip(some, both.align(some), strict=True):
            assert ";".join(b.groups for b in blocks or []) == described(text)[0], text


def test_product_of_sparse_matrices():
    rng = random.Random(6)
    for _ in range(50):
        shape = [rng.randint(0, 6) for _ in range(3)]
        left = np.array([[rng.random() < 0.4 for _ in range(shape[1])] for _ in range(shape[0])], int).reshape(shape[:2])
        right = np.array([[rng.random() < 0.4 for _ in range(shape[2])] for _ in range(shape[1])], int).reshape(shape[1:])
        csr = [
            alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(axis=1))]).astype(int), np.nonzero(m)[1], m.shape[1])
            for m in (left, right)
        ]
        row, column, value = alignment.gustavson(*csr)
        dense = np.zeros((shape[0], shape[2]), int)
        dense[row, column] = value
        assert (dense == left @ right).all() and len(row) == np.count_nonzero(left @ right)


def test_query_over_the_whole_table(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    assert rows_of(QUERIES["op11_alignment"](spark, sf_dir)) == expected(rows)
