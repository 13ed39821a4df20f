import random

import numpy as np
from pyspark.sql import functions as F

from docpipe.llm import toxicity as T


def plain_slots(text):
    words = text.lower().split()
    grams = set()
    for w in words:
        p = b" " + w + b" "
        for n in T.ORDERS:
            grams |= {p[i : i + n] for i in range(len(p) - n + 1)}
        if len(p) > max(T.ORDERS):
            grams.add(p)
    return grams


def test_slots_are_the_ngrams_of_words():
    text = "Der Fluß  war\tlang, extraordinarily so \n x".encode()
    assert len(set(T.slots(np.frombuffer(text, np.uint8), 40).tolist())) >= 0.9 * len(plain_slots(text))
    one, two = (set(T.slots(np.frombuffer(t, np.uint8), 20).tolist()) for t in (b"some words", b"  WORDS\nsome "))
    assert one == two
    assert len(T.slots(np.zeros(0, np.uint8))) == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = np.frombuffer(b"calm words here " * 500 + b"vilest", np.uint8)
    whole = set(T.slots(text).tolist())
    monkeypatch.setattr(T, "_PART", 64)
    assert set(T.slots(text).tolist()) == whole


def corpus(n, seed=0):
    rng = random.Random(seed)
    syll = ["ka", "lo", "mi", "ten", "ra", "do", "su"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        y = int(i % 6 == 0)
        for _ in range(2 * y):
            words[rng.randrange(len(words))] = rng.choice(["vilefool", "zounds", "wretch"])
        rows.append((i, " ".join(words), y))
    return rows


def test_held_out_accuracy_and_edge_rows(spark, make_docs):
    rows = corpus(900)
    extra = [(2000, None), (2001, ""), (2002, "wretch " * 30_000), (None, "kalo mi"), (3, rows[3][1])]
    docs = make_docs([r[:2] for r in rows] + extra)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(4, 0, 7), (None, 1, 1), (2001, 1, None)], "doc_id long, quality int, toxic int")
    found = T.score_toxicity(docs, labels).collect()
    assert len(found) == len(rows) + len(extra)
    by = {r.doc_id: r for r in found}
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert len(held) > 100 and sum(p == y for p, y in held) >= 0.97 * len(held)
    assert by[2002].predicted == 1 and by[2000].score == by[2001].score and by[2000].predicted == 0
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in T.score_toxicity(docs, labels).collect()} == {0}
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in T.score_toxicity(docs, one).collect()} == {0}
    assert T.score_toxicity(docs.limit(0), labels).count() == 0


def test_a_class_of_long_texts_only(spark):
    long = [(k, "vilest insults here " * 30_000 + str(k)) for k in range(4)]  # 600 kB each
    short = [(100 + k, f"calm words of number {k}") for k in range(80)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in long + short], "doc_id long, toxic int")
    model = T.train_model(docs, labels, F.lit(True), sample_mb=6)
    assert model.score(np.frombuffer(b"vilest insults", np.uint8)) > 0.5 > model.score(np.frombuffer(b"calm words of number 7", np.uint8))
