import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from docpipe.llm import substring_dedup
from docpipe.llm.shared import planes
from docpipe.llm.substring_dedup import _tell_first, dedup_substrings, locate


def digest(text):
    """Spark's 64-bit digest, signed; a null's is the seed."""
    return 42 if text is None else int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64))


def brute(rows, width=20):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, digest(rows[k][1])))
    seen, out = set(), []
    for k in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", rows[k][1] or "")
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            w = tuple(words[s : s + width])
            if w in seen:
                gone[s : s + width] = [True] * width
            seen.add(w)
        out.append((str(rows[k][0]), len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out)


def test_agrees_with_brute_force(make_docs, prose):
    passage, other = prose(60), prose(25)
    rows = [(i, prose(10 + i % 50)) for i in range(60)]
    rows += [(100 + i, f"{prose(i % 7)} {passage} {prose(9)}") for i in range(40)]
    rows += [(200 + i, f"{prose(5)} {other}\n{prose(30)} {passage[: 40 * (i + 3)]}") for i in range(10)]
    rows += [(300, "same " * 90), (301, "same " * 50 + "end"), (302, "a b " * 40), (303, "b a " * 40 + "same " * 25), (304, (prose(7) + " ") * 12)]
    rows += [(400, rows[60][1]), (401, rows[60][1]), (-5, rows[61][1]), (402, None), (403, ""), (404, " \t"), (405, other.upper()), (None, passage), (None, passage + " x"), (100, rows[60][1])]
    for least in (1, 6):
        found = dedup_substrings(make_docs(rows).repartition(3), least_groups=least).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in found) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_over_two_words(make_docs, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(rng.choice(["a", "b"], rng.integers(0, 120), p=[0.9, 0.1]))) for i in range(30)]
    found = dedup_substrings(make_docs(rows), least_groups=4).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in found) == brute(rows)


def told(docs, **how):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(docs, **how).collect())


def test_hashes_that_collide_change_nothing(make_docs, prose):
    """With a bit of each word's hash nearly every window seems to recur; the automata say which do."""
    passage = prose(50)
    rows = [(i, prose(30 + i)) for i in range(12)] + [(20 + i, f"{prose(3)} {passage} {prose(4)}") for i in range(4)]
    assert told(make_docs(rows), least_groups=3, bits=1) == told(make_docs(rows), least_groups=3, bits=2, shard=40) == brute(rows)


def test_result_comes_from_the_automata(make_docs, prose, monkeypatch):
    windows = [tuple(range(k, k + 6)) for k in range(3)] + [tuple(range(6))]
    assert len(set(locate(windows, np.zeros(4), 5).tolist())) == 4
    table = pa.table({"bucket": [0, 0], "p": [0, 1], "asked": [sent(1, b"a b c d e f"), sent(2, b"a b c d e f")]})
    flags = lambda: [list(x) for x in _tell_first(5, 100)(table)["told"].to_pylist()]
    assert flags() == [[1, 1], [0, 0]]
    monkeypatch.setattr(substring_dedup, "locate", lambda passages, *_: np.arange(sum(len(t) - 4 for t in passages)) * 0)
    assert flags() == [[1, 0], [0, 0]]


def sent(doc_id, words):
    one = lambda x, n: planes(np.array([x], np.uint64), n)
    return (1).to_bytes(4, "little") + one(9, 4) + one(doc_id, 8) + one(0, 8) + one(0, 8) + one(0, 5) + words


@pytest.mark.parametrize("seed", range(5))
def test_automata_of_any_size_agree(seed):
    rng = np.random.default_rng(seed)
    passages = [tuple(rng.integers(0, 3, rng.integers(5, 40)).tolist()) for _ in range(60)]
    anchors = rng.integers(0, 4, 60)
    plain = [(a, t[k : k + 5]) for t, a in zip(passages, anchors.tolist()) for k in range(len(t) - 4)]
    for shard in (1, 9, 1000):
        found = locate(passages, anchors, 5, shard).tolist()
        numbers = {*zip(found, plain)}  # of windows under their anchors
        assert len(numbers) == len({*zip(found, (a for a, _ in plain))}) == len({*plain})


def test_rows_without_an_id_are_dealt_out_and_long_texts(make_docs, prose):
    passage = prose(400)
    rows = [(None, f"{prose(20)} {passage}") for _ in range(30)] + [(None, None)] * 5 + [(None, "")] * 5 + [(7, prose(30_000) + " " + passage)] + [(None, passage)] * 9
    assert told(make_docs(rows), least_groups=5) == brute(rows)


def test_carries_columns_and_empty_tables(make_docs, prose):
    docs = make_docs([(1, prose(30), "s1"), (2, None, None)])
    found = {r.doc_id: r for r in dedup_substrings(docs, carry=docs.columns, least_groups=2).collect()}
    assert found[1].rest.source == "s1" and found[2].rest.source is None and found[1].rest.p == 1
    assert dedup_substrings(make_docs([])).count() == 0
