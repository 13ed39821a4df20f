import random

import pytest

import corpus_pipeline as P
from docpipe.llm.near_copies import near_copies


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.fixture
def copies(prose):
    """Texts with changed words, among them chains and a large group around one text."""
    rng = random.Random(11)

    def change(text, n):
        words = text.split()
        for k in rng.sample(range(len(words)), n):
            words[k] = f"zz{rng.random()}"
        return " ".join(words)

    texts = [prose(n) for n in (1, 3, 4, 5, 9, 30, 69, 200, 900)]
    texts += [change(t, n) for t in texts[5:] for n in (1, 2, 4, 9) for _ in range(3)]
    chain = [prose(120)]
    for _ in range(5):
        chain.append(change(chain[-1], 2))
    hub, line = prose(100), prose(20)
    many = [change(hub, rng.choice((1, 1, 2))) for _ in range(90)] + [f"{line} {prose(4)}" for _ in range(90)]
    return list(enumerate([*texts, *chain, *many, texts[6].upper(), texts[1], "", None, " \n"]))


@pytest.mark.parametrize("limit, banded", [(4, True), (64, True), (4, False), (64, False)])
def test_links_connect_all_near_copies(make_docs, copies, limit, banded):
    s = [shingles(t or "") for _, t in copies]
    near = [(a, b) for b in range(len(s)) for a in range(b) if s[a] and s[b] and 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b])]
    links = [(r.a, r.b) for r in near_copies(make_docs(copies), list_limit=limit, banded=banded).collect()]
    assert {(min(x), max(x)) for x in links} <= set(near)
    assert groups(range(len(s)), links) == groups(range(len(s)), near)


def test_stage_drops_near_copies(spark, prose):
    text = prose(69)
    words = text.split()
    near = " ".join([*words[:20], "other", *words[21:]])
    rows = [(3, text), (4, near), (None, near + " end"), (5, prose(60)), (5, near), (6, prose(60)), (None, prose(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {(r.doc_id, r.text) for r in P.drop_near_duplicates(spark, docs, "").collect()}
    assert left == {rows[k] for k in (0, 3, 5, 6)}


def test_copies_of_an_original_in_the_middle(make_docs, prose):
    """Changed copies are near their original only; its id is neither the smallest nor the largest."""
    rng = random.Random(6)
    words = prose(300).split()

    def copy():
        own = list(words)
        for k in rng.sample(range(300), 6):
            own[k] = f"zz{rng.random()}"
        return " ".join(own)

    rows = [(k, copy() if k != 57 else " ".join(words)) for k in range(120)]
    s = [shingles(t) for _, t in rows]
    near = [(a, b) for b in range(len(s)) for a in range(b) if 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b])]
    links = [(r.a, r.b) for r in near_copies(make_docs(rows)).collect()]
    assert groups(range(len(s)), links) == groups(range(len(s)), near) and len(links) < 500


def test_frequent_shingles_and_long_texts(make_docs, prose):
    """One passage in most texts, so that its shingles are frequent in the sample; long texts among near copies."""
    passage, long = prose(60), prose(30_000)
    texts = [f"{passage} {prose(1 + k % 9)}" for k in range(200)] + [long, f"{long} end", prose(200), f"{prose(2)} {long}"]
    s = [shingles(t) for t in texts]
    near = [(a, b) for b in range(len(s)) for a in range(b) if 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b])]
    for banded in (True, False):
        links = [(r.a, r.b) for r in near_copies(make_docs(list(enumerate(texts))), list_limit=8, banded=banded).collect()]
        assert groups(range(len(s)), links) == groups(range(len(s)), near)


def test_empty_table(make_docs):
    assert near_copies(make_docs([])).count() == 0


def test_signatures_differ_as_expected():
    import numpy as np

    from docpipe.llm import near_copies as N

    rng = np.random.default_rng(3)
    for size in (6, 40, 300, 3000):
        shared, own = size * 8 // 9, size - size * 8 // 9  # a similarity of at least 0.8
        owner, h = [], []
        for pair in range(200):
            both = rng.integers(0, 2**64, shared, dtype=np.uint64)
            for side in range(2):
                h.append(np.sort(np.concatenate([both, rng.integers(0, 2**64, own, dtype=np.uint64)])))
                owner.append(np.full(size, 2 * pair + side))
        sign = N.signatures(np.concatenate(owner), np.concatenate(h), 400)
        for s, of in zip(sign[:4], h[:4]):
            bits = [0] * N.BITS
            for x in sorted(of.tolist(), reverse=True):
                bits[x >> 57] = x & 1
            assert s.tobytes() == np.packbits(bits).tobytes()
        differ = np.bitwise_count((sign[::2] ^ sign[1::2]).view(np.uint64)).sum(axis=1)
        assert differ.max() <= N.limits(0.8)[min(2 * size, N.BITS)]
        apart = np.bitwise_count((sign[:-2:2] ^ sign[2::2]).view(np.uint64)).sum(axis=1)
        assert size < 300 or (apart > N.limits(0.8)[N.BITS]).mean() > 0.99
    assert (np.diff(N.limits(0.8)) >= 0).all() and N.limits(1.0).max() == 0
    assert N.signatures(np.zeros(0, np.int64), np.zeros(0, np.uint64), 2).tolist() == [[0, 0], [0, 0]]
