import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F
from loanloom.llm import decontaminate, quality, url_filter
from loanloom.llm.queries import QUERIES, SQL, URL_RULES

from .samples import documents, empty_documents, hard_documents, prose, texts


def rowset(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


# quality


def base_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def score_by_hand(text, raw_texts, good_texts):
    def buckets(t):
        return quality.gram_buckets(np.frombuffer((t or "").encode(), np.uint8)).tolist()

    raw, target = Counter(), Counter()
    for t in raw_texts:
        raw.update(buckets(t))
    for t in good_texts:
        target.update(buckets(t))
    n_raw, n_target = sum(raw.values()), sum(target.values())
    total, grams = 0, buckets(text)
    for b in grams:
        p = (target[b] + 0.5) / (n_target + 0.5 * quality.BUCKETS)
        q = (raw[b] + 0.5) / (n_raw + 0.5 * quality.BUCKETS)
        total += int(np.rint(np.log(p / q) * quality.UNIT))
    return total / max(len(grams), 1) / quality.UNIT


def test_quality_against_brute_force(spark):
    df = hard_documents(spark)
    labels = spark.createDataFrame(
        [(0, 1), (1, 1), (4, 1), (17, 0), (10, 0), (None, 1), (99, 0), (3, None)], "doc_id long, quality int"
    )
    rows = df.collect()
    good = [r.text for r in rows if r.doc_id in (0, 1, 4)]
    found = quality.judge(df, labels, keep=["text", "score"]).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.text) for r in rows)
    for r in found:
        base = tuple(r[c] for c in quality.BASE)
        assert base == base_by_hand(r.text)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)
    plain = {(r.doc_id, r.n_words): r.score for r in quality.judge(df, labels).collect()}
    for r in found:
        expected = score_by_hand(r.text, [x.text for x in rows], good)
        assert abs(plain[r.doc_id, r.n_words] - expected) < 1e-9


def test_quality_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.judge(documents(spark), labels).collect()
    assert all(r.kept != r.base_failed for r in found)
    assert quality.judge(empty_documents(spark), labels).collect() == []


def test_quality_threshold():
    s, y = np.array([1.0, 2, 3, 4]), np.array([0, 0, 1, 1])
    assert quality.best_threshold(s, y) == 2.5
    assert quality.best_threshold(s, np.ones(4)) == float("-inf")
    assert quality.best_threshold(np.array([1.0, 1, 5]), np.array([0, 1, 1]), 10) == float("-inf")


def test_quality_threshold_of_counted_scores():
    rng = np.random.default_rng(4)
    s, y = rng.integers(0, 30, 500).astype(float), rng.integers(0, 2, 500)
    pairs, counts = np.unique(np.stack([s, y]), axis=1, return_counts=True)
    for cost in (0.5, 1, 3):
        assert quality.best_threshold(pairs[0], pairs[1], cost, counts) == quality.best_threshold(s, y, cost)


def test_quality_with_labels_beyond_the_broadcast(spark, monkeypatch):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    found = sorted(map(str, quality.judge(documents(spark), labels).collect()))
    monkeypatch.setattr(quality, "BROADCAST_LABELS", 3)
    assert found == sorted(map(str, quality.judge(documents(spark), labels).collect()))


def test_quality_on_held_out_labels(spark):
    """Learnt from the labels of every other document, judged on the rest."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 2 == 1
    found = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), labels.where(~held))
    rows = found.join(labels.where(held), "doc_id").collect()
    assert len(rows) > 1000
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.95 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_quality_keeps_what_is_labelled_good(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op2_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


# decontamination


def hits_by_hand(text, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = pattern.findall((text or "").translate(low))
    hit, found = set(), set()
    for name, item in items:
        w = pattern.findall((item or "").translate(low))
        if name is None or not w:
            continue
        windows = {tuple(w[i : i + window]) for i in range(len(w) - window + 1)} or {tuple(w)}
        n = min(window, len(w))
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    a = texts()[0]
    words = a.split()
    items = [
        (1, " ".join(words[50:80])),
        (2, "  ".join(words[70:90]).upper()),
        (10, " ".join(words[200:206])),
        (3, "four words IN all"),
        (4, None),
        (5, "..."),
        (None, " ".join(words[0:30])),
        (7, " ".join(words[50:61]) + " " + " ".join(words[300:315])),
        (8, "one"),
        (8, "one"),
        (9, prose(40, 40)),
        (11, "ab ab ab ab ab ab ab ab ab ab ab ab"),
        (12, "ab ab ab"),
    ]
    df = hard_documents(spark)
    table = spark.createDataFrame(items, "item_id long, text string")
    for max_words in (1_000_000, 40):
        found = decontaminate.find_test_items(df, table, max_words=max_words, keep=["text", "lang"]).collect()
        expected = [(r.doc_id, *hits_by_hand(r.text, items)) for r in df.collect()]
        assert rowset((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == rowset(expected)
    for r in decontaminate.find_test_items(df, table).collect():
        assert len(r.spans) % 2 == 0 and (r.n_hit > 0) == bool(r.spans)
        if r.doc_id == 9:
            assert r.clean_text == ""


def test_decontamination_random(spark):
    vocabulary = ["a", "b", "c", "d"]
    rng = np.random.default_rng(5)
    docs = [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(80)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 15)))) for i in range(12)]
    table = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.find_test_items(documents(spark, docs), table, window=5).collect()
    expected = [(i, *hits_by_hand(t, items, 5)) for i, t in enumerate(docs)]
    assert rowset((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == rowset(expected)


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_test_items(documents(spark), none).collect()
    assert all(r.n_hit == 0 for r in found) and len(found) == len(texts())
    assert decontaminate.find_test_items(empty_documents(spark), none).collect() == []


def test_decontamination_query(spark):
    folder = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    expected = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n, hit, names = hits_by_hand(r.text, items)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        expected.append((r.doc_id, n, hit, len(names), digest, hit > 0))
    assert rowset(QUERIES["op5_decontamination"](spark, folder).collect()) == rowset(expected)
    assert sum(e[-1] for e in expected) > 0


# urls


def test_url_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS FROM '{folder}/pages.parquet'")
    found = QUERIES["op9_url_filter"](spark, folder)
    assert rowset(found.select("page_id", "host", "path", "rule", "verdict").collect()) == rowset(
        con.sql(SQL["op9_url_filter"]).fetchall()
    )


def test_url_cases(spark):
    urls = [
        None,
        "",
        "no scheme.org/es/",
        "http://EXAMPLE.org/es/x?y#z",
        "http://a.example.org/en/12",
        "http://notexample.org/es/",
        "http://org",
        "http://org/",
        "x://y.com/de/#q",
        "x://y.com/fr",
        "://com/fr/",
        "http:///fr/",
        "http://adult-x.net/.org/",
        "http://é.net/\n/a://b.org/",
        "http://a.net/" + "p" * 20000 + "/.example.org/es/",
        "http://a.net/" + "p" * 20000,
    ]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(None, urls[3], "a", "b"), (3, urls[3], "a", "b")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = url_filter.filter_urls(df, URL_RULES).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    assert rowset(found) == rowset(con.sql(SQL["op9_url_filter"]).fetchall())
    empty = spark.createDataFrame([], df.schema)
    assert url_filter.filter_urls(empty, URL_RULES).collect() == []


def test_globs_against_regular_expressions():
    rng = np.random.default_rng(7)
    globs = [b"*", b"", b"a*b", b"*ab*", b"??", b"*a?b", b"ab*", b"*b" + b"a" * 70 + b"*", b"a**b*", b"abab"]
    texts_ = [bytes(rng.choice([97, 98], rng.integers(0, 9)).astype(np.uint8)) for _ in range(300)]
    texts_ += [b"b" + b"a" * 70, b"xb" + b"a" * 80 + b"c", b"b" + b"a" * 69]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts_])])
    found = url_filter.GlobAutomaton(globs).match(np.frombuffer(b"".join(texts_), np.uint8), offsets)
    for k, g in enumerate(globs):
        pattern = re.compile(b"".join({42: b".*", 63: b"."}.get(c, re.escape(bytes([c]))) for c in g), re.S)
        assert found[:, k].tolist() == [bool(pattern.fullmatch(t)) for t in texts_], g
