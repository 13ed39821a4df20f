import numpy as np
import pytest
from pyspark.sql import functions as F

from docpipe.llm import language_id as L

EN = "the river was long and the water that ran with it was cold for them".split()
DE = "der fluss war lang und das wasser mit dem sie nicht fahren durften".split()


def brute(word, prob, pieces):
    """Sum over all segmentations by recursion."""
    if not word:
        return 1.0
    return sum(prob[p] * brute(word[k:], prob, pieces) for k in range(1, min(pieces, len(word)) + 1) if (p := word[:k]) in prob)


def test_forward_sums_all_segmentations():
    pieces = L.Pieces(["a", "ab", "b", "▁a", "ba", "▁", "bab", "é"])
    vocab = sorted({" a", "a", "ab", "b", "ba", " ", "bab", "é"}, key=str.encode)
    vocab = sorted(v.encode() for v in vocab)
    rng = np.random.default_rng(0)
    prob = rng.random((pieces.n, 2))
    model = L.Model(pieces, ["x", "y"], prob, np.ones(2))
    words = [b" abab", b" ba", b"abc", " aé".encode(), b"a", b" bababab"]
    for j in range(2):
        table = {bytes([b]): prob[pieces.size + b, j] for b in range(256)} | {v: prob[k, j] for k, v in enumerate(vocab)}
        expected = [np.log(brute(w, table, 16)) for w in words]
        assert np.allclose(model.word_scores(words)[:, j], expected)


def by_steps(word, table, longest):
    """log of the sum over all segmentations, byte after byte."""
    ways = [0.0] + [-np.inf] * len(word)
    for i in range(1, len(word) + 1):
        ways[i] = np.logaddexp.reduce([ways[k] + np.log(table[word[k:i]]) for k in range(max(0, i - longest), i) if word[k:i] in table])
    return ways[-1]


@pytest.mark.parametrize("text", ["ภาษาไทยไม่มีช่องว่างระหว่างคำในประโยคที่ยาวมาก", "नमस्ते दुनिया", "中文句子没有空格所以一个词很长很长很长很长很长", "donaudampfschifffahrtsgesellschaft" * 3, "x" * 5_000, "straße " + "né" * 400])
def test_words_of_any_length_and_script(text):
    pieces = L.Pieces(L.vocabulary())
    prob = np.random.default_rng(3).random((pieces.n, 2)) / 50
    model = L.Model(pieces, ["x", "y"], prob, np.ones(2))
    words = L.cut_words(text.encode())
    assert b"".join(words).replace(b" ", b"") == text.replace(" ", "").encode()  # nothing is cut off
    for j in range(2):
        table = {bytes([b]): prob[pieces.size + b, j] for b in range(256)} | {p: prob[i, j] for p, i in pieces.of.items()}
        assert np.allclose(model.word_scores([b" the", *words])[1:, j], [by_steps(w, table, pieces.longest) for w in words])


def test_no_piece_that_words_can_hold_is_left_out():
    pieces = L.Pieces(L.vocabulary())
    can = {p.replace("▁", " ").lower() for p in L.vocabulary()}
    assert {p.encode() for p in can if p.lstrip(" ").isalpha() and not p.startswith("  ")} <= set(pieces.of)
    assert L.normalise("नमस्ते, ๒ ่".encode()) == "नमस्ते    ่".encode() and L.normalise("่ ่".encode()) == b""


def test_equal_posteriors_go_to_the_first_language():
    pieces = L.Pieces(["a"])
    model = L.Model(pieces, ["aa", "bb"], np.full((pieces.n, 2), 0.1), np.full(2, 0.5))
    z = model.word_scores([b" a"])[0] + model.prior
    assert z[0] == z[1] and int(z.argmax()) == 0


def test_em_raises_the_likelihood():
    pieces = L.Pieces(L.vocabulary())
    counts = {"en": {b" " + w.encode(): 3 for w in EN}, "de": {b" " + w.encode(): 2 for w in DE}}
    score = []
    for rounds in (1, 2, 5):
        m = L.train(counts, {"en": 1, "de": 1}, pieces, rounds=rounds, smooth=1e-9)
        score.append(sum(n * m.word_scores([w])[0, m.langs.index(lang)] for lang, c in counts.items() for w, n in c.items()))
    assert score == sorted(score)


def test_predictions_and_edge_rows(spark, make_docs):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(EN if i % 2 else DE, 12)), "en" if i % 2 else "de") for i in range(120)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "123 !?", None), (503, "THE RIVER " * 20_000, None), (504, "x" * 100_000, None), (None, "das Wasser", None), (0, rows[0][1], "de")]
    docs = make_docs([(i, t, "s") for i, t, _ in rows]).drop("fp")
    langs = spark.createDataFrame([(i, lang) for i, _, lang in dict((r[0], r) for r in rows).values()], "doc_id long, lang string")
    docs = docs.join(langs, docs.doc_id.eqNullSafe(langs.doc_id)).drop(langs.doc_id)
    found = L.identify_languages(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == lang for i, _, lang in rows[:120])
    assert [by[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and by[500].score == 0
    assert by[503].lang_pred == "en" and by[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in L.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert L.identify_languages(docs.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = L.identify_languages(docs).where("held_out").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert len(found) > 20 and sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


@pytest.mark.parametrize("text, out", [("Ab1c É.ß", b"ab c \xc3\xa9 \xc3\x9f"), ("a-b", b"a b")])
def test_normalise(text, out):
    assert L.normalise(text.encode()) == out


def test_languages_of_long_texts_only(spark):
    """Each language teaches, whatever the length of its texts, and however many share the sample."""
    long = [(k, " ".join(EN * 9_000) + f" {k}", "en") for k in range(6)]  # half a MB each
    short = [(100 + k, " ".join(DE) + f" {k}", "de") for k in range(60)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.identify_languages(docs, F.lit(False), sample_mb=1).collect()}
    assert all(v == ("en" if k < 100 else "de") for k, v in got.items())


def test_a_hundred_languages(spark):
    rng = np.random.default_rng(4)
    rows = []
    for lang in range(100):
        words = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(30)]
        rows += [(lang * 10 + k, " ".join(rng.choice(words, 700)), f"l{lang:02d}") for k in range(4)]  # 4 kB each
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = L.identify_languages(docs, F.col("doc_id") % 10 == 3).where("held_out").collect()
    assert len(got) == 100 and sum(r.lang_pred == f"l{r.doc_id // 10:02d}" for r in got) >= 99


def test_long_words_teach_whole():
    word = (" " + "né" * 3_000).encode()
    parts = L.in_parts(word)
    assert b"".join(parts) == word and max(map(len, parts)) <= L.AT_ONCE and all(p.decode() for p in parts)
    pieces = L.Pieces(["▁", "n", "é", "x", "y"])
    model = L.train({"a": {b" " + b"n" * 1_500 + b"x" * 1_500: 1}, "b": {b" " + b"n" * 1_500 + b"y" * 1_500: 1}}, {"a": 1, "b": 1}, pieces)
    scores = model.word_scores([b"xxxx", b"yyyy"])
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0]
