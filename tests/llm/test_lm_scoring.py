import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docpipe.llm.lm_scoring import learn_weights, score_documents


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")), None]


def brute_force(rows, order=3):
    """Counts and scores with plain dictionaries, and EM over single events."""
    mod = lambda i: zlib.crc32(str(i).encode()) % 10
    grams = [{k: Counter() for k in ("kept", "gone")} for _ in range(order)]
    docs = Counter()

    def runs(text):
        seen = ["<s>"] * (order - 1) + tokens(text)
        return [[tuple(seen[i - k : i + 1]) for k in range(order)] for i in range(order - 1, len(seen))]

    for i, text in rows:
        if mod(i) == 0:
            continue
        part = "gone" if mod(i) == 1 else "kept"
        docs[part] += 1
        for run in runs(text):
            for k, gram in enumerate(run):
                grams[k][part][gram] += 1

    def facts(run, count, tokens, n_docs):
        """Bucket, and estimates from the longest on."""
        contexts = [n_docs if gram[0] == "<s>" and set(gram[:-1]) == {"<s>"} else count(k, gram[:-1]) for k, gram in enumerate(run[1:])]
        estimates = [count(k, run[k]) / contexts[k - 1] if contexts[k - 1] else 0 for k in range(order - 1, 0, -1)] + [count(0, run[0]) / max(tokens, 1)]
        bucket = 0
        for k, c in enumerate(contexts):
            bucket = k * 48 + 1 + int(math.log2(c)) if c else bucket
        return bucket, estimates

    total = [g["kept"] + g["gone"] for g in grams]
    n, v = sum(total[0].values()), len(total[0])
    events, kept_n = Counter(), sum(grams[0]["kept"].values())
    for i, text in rows:
        if mod(i) == 1:
            for run in runs(text):
                bucket, estimates = facts(run, lambda k, g: grams[k]["kept"][g], kept_n, docs["kept"])
                events[(bucket, *(1 + round(-4 * math.log2(p)) if p > 0 else 0 for p in estimates))] += 1
    weights = learn_weights(np.array([(*e, c) for e, c in sorted(events.items())], np.int64).reshape(-1, order + 2), order, 1 / (v + 1))
    out = {}
    for i, text in rows:
        base = score = known = 0
        for run in runs(text):
            bucket, estimates = facts(run, lambda k, g: total[k][g], n, sum(docs.values()))
            c = total[0][run[0]]
            base += math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            score += math.log10(sum(w * p for w, p in zip(weights[bucket], [*estimates, 1 / (v + 1)])))
            known += c > 0
        out[i] = (mod(i) == 0, len(tokens(text)), known, n, base, score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_agrees_with_plain_counts(make_docs, prose, order):
    rows = [(i, prose(3 + i % 40)) for i in range(300)] + [(900, None), (901, ""), (902, " \t\n"), (903, "The THE the É é"), (904, "the " * 3000)]
    found = {r.doc_id: r for r in score_documents(make_docs(rows), order=order, group_mb=1, least_groups=5).collect()}
    expected = brute_force(rows, order)
    assert found.keys() == expected.keys()
    for i, (held, n, known, train, base, score) in expected.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_held_out_text_is_likelier_than_under_unigrams(make_docs, prose):
    rows = [(i, " ".join(f"{w} x{w}" for w in prose(60).split())) for i in range(200)]
    held = [r for r in score_documents(make_docs(rows), least_groups=3).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held) + 100


def test_probabilities_sum_to_one():
    # a bucket's weights are a distribution, also where no event was seen
    for order in (1, 2, 3):
        events = np.array([(0, *[0] * (order - 1), 3, 5), *([(4, *[0] * (order - 2), 2, 9, 7)] if order > 1 else [])])
        w = learn_weights(events, order, 1e-3)
        assert np.allclose(w.sum(1), 1) and (w >= 0).all() and (w[0, : order - 1] == 0).all()
        assert len(w) == 1 + 48 * (order - 1)


def test_longer_context_helps_and_long_texts(make_docs, prose):
    verse = [f"{a} {b} {a}{b}" for a in prose(40).split() for b in prose(4).split()]
    rows = [(i, " ".join(verse[(7 * i + k * k) % 160] for k in range(60))) for i in range(120)] + [(500, prose(50_000)), (505, None)]
    held = {n: sum(r.score for r in score_documents(make_docs(rows), order=n, least_groups=3).collect() if r.held_out) for n in (2, 3)}
    assert held[3] > held[2]


def test_repeated_rows_null_ids_and_empty_tables(make_docs):
    rows = [(5, "a b"), (5, "a b"), (None, "a c")]
    found = score_documents(make_docs(rows), least_groups=2).collect()
    assert len(found) == 3 and len({(r.score, r.n_tokens) for r in found if r.doc_id == 5}) == 1
    assert score_documents(make_docs([]), least_groups=2).count() == 0
