import itertools
import random

import numpy as np
import pytest
from loanloom.llm import toxicity
from loanloom.llm.queries import QUERIES

from .samples import documents, empty_documents, hard_documents, prose


@pytest.fixture(scope="module")
def model(spark):
    words = ["idiot", "stupid", "worthless", "clown", "pathetic", "moron"]
    texts = [prose(i, 200) + " " + " ".join(words) for i in range(30)]
    return toxicity.character_model(toxicity.character_counts(documents(spark, texts), "text"))


@pytest.mark.parametrize(
    ("seen", "meant"),
    [
        ("1d10t", "idiot"),
        ("$tup1d", "stupid"),
        ("w0rthle55", "worthless"),
        ("stuuuupid", "stupid"),
        ("i.d.i.o.t", "idiot"),
        ("c-l-0-w-n", "clown"),
        ("idiot", "idiot"),
        ("m*ron", "moron"),
        ("p@th3t1c", "pathetic"),
    ],
)
def test_decode(model, seen, meant):
    assert toxicity.Restorer(model)(seen) == meant


def test_decode_is_the_cheapest_path(model):
    def cost(path):
        state, total = (0, 0, 0), 0.0
        for text, extra in path:
            total += extra
            for c in text:
                total -= float(model[(*state, toxicity._code(c))])
                state = (*state[1:], toxicity._code(c))
        return total - float(model[(*state, 0)])

    rng = random.Random(1)
    for _ in range(60):
        word = "".join(rng.choices("abt1035$.o", k=rng.randint(1, 6)))
        paths = list(itertools.product(*toxicity._slots(word)))
        best = min(cost(p) for p in paths)
        got = toxicity.decode(word, model)
        found = [cost(p) for p in paths if "".join(t for t, _ in p) == got]
        assert min(found) == pytest.approx(best, abs=1e-4)


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("you are a i d i o t", "idiot"),
        ("w e y o u i d i o t", "idiot"),
        ("s t u p i d c l o w n", "clown"),
        ("a m o r o n. c l o w n", "moron"),
        ("that c l o w n!", "clown"),
        ("stu" + "u" * 100 + "pid", "stupid"),
        ("i" + "d" * 70 + "1" + "o" * 70 + "t", "idiot"),
        ("c....l....o....w....n", "clown"),
        ("-".join("idiot") + "-" * 80 + "-".join("clown"), "clown"),
        (" ".join("thewater" * 12 + "idiot"), "idiot"),
    ],
)
def test_words_of_a_run_and_long_words(model, text, word):
    data = np.frombuffer(text.encode(), np.uint8)
    *_, found = toxicity._words(data, np.array([0, len(data)]), toxicity.Restorer(model))
    assert (0, word) in found


def test_pieces_do_not_change_the_path(model, monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choices("idotsup1035$.", k=150)) for _ in range(20)]
    found = [toxicity.decode(w, model, ends) for w in words for ends in (False, True)]
    monkeypatch.setattr(toxicity, "PIECE", 10**9)
    assert found == [toxicity.decode(w, model, ends) for w in words for ends in (False, True)]


def test_model_is_a_distribution(model):
    assert np.allclose(np.exp(model).sum(-1), 1, atol=1e-4)


def small_world(spark):
    rng = random.Random(9)
    bad = ["idiot", "stupid", "worthless", "clown"]
    shown = ["1d1ot", "$tupid", "w0rthless", "c l o w n", "stuuupid", "i-d-i-o-t"]
    values, labels = [], []
    for i in range(400):
        words = prose(1000 + i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad if i < 320 else shown)
        values.append(" ".join(words))
        labels.append((i, int(toxic)))
    return documents(spark, values), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_disguised_words_are_found(spark):
    docs, labels = small_world(spark)
    rows = toxicity.score(docs, labels.where("doc_id < 320")).collect()
    assert len(rows) == 400
    late = [r for r in rows if r.doc_id >= 320]
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in late)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert any("clown" in r.restored for r in late)


def test_held_out_labels_are_not_read(spark):
    docs, labels = small_world(spark)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(doc_id as string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    a = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in toxicity.score(docs, flipped).collect()}


def test_hard_rows(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (77, 1), (3, None)], "doc_id long, toxic int")
    df = hard_documents(spark)
    rows = toxicity.score(df, labels).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.score(df, labels.where("false")).collect()
    assert all(r.score == 0.5 for r in none)
    assert toxicity.score(empty_documents(spark), labels).collect() == []


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op8_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    # some toxic labels are of texts without any word to tell them by
    assert sum(r.predicted for r in toxic) >= 0.92 * len(toxic) > 20
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
