import math
import random
import re
import time
from itertools import accumulate

import pytest

from docpipe.llm import decontaminate as D
from docpipe.llm.decontaminate import overlaps


@pytest.fixture
def tables(spark, make_docs, prose):
    rng = random.Random(3)
    items = [prose(n) for n in (15, 20, 35, 60, 6, 3)]

    def swap(text, n):
        words = text.split()
        for k in rng.sample(range(len(words)), n):
            words[k] = f"zz{k}"
        return " ".join(words)

    rows = [(i, prose(80)) for i in range(40)]
    rows += [(100, f"{prose(10)} {items[0]} {prose(10)}"), (101, items[1].upper() + " " + prose(30)), (102, prose(5) + " " + swap(items[2], 6)), (103, "### ".join(items[3].split())), (104, " ".join(items[3].split()[20:45])), (105, swap(items[0], 3)), (106, items[4] + " " + prose(9)), (107, items[5])]
    rows += [(108, " ".join(items[3].split()[:8]) + " " + prose(30)), (109, None), (110, ""), (None, items[1]), (100, rows[40][1]), (111, (prose(50) + " ") * 2000 + items[2])]
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)] + [(6, None, 1), (7, "", 1)], "item_id long, text string, doc_id int")
    return make_docs(rows), bench


EXPECTED = {(100, 0), (101, 1), (102, 2), (103, 3), (104, 3), (105, 0), (106, 4), (None, 1), (111, 2)}


@pytest.mark.parametrize("broadcast_mb", [32, -1])
def test_planted_overlaps(tables, broadcast_mb):
    found = overlaps(*tables, broadcast_mb=broadcast_mb).collect()
    assert {(r.doc_id, r.item_id) for r in found} == EXPECTED and len(found) == len(EXPECTED)
    by = {r.doc_id: r for r in found}
    assert (by[100].n_matched, by[100].doc_start, by[100].doc_end) == (15, 10, 25)
    assert (by[104].n_matched, by[104].item_start, by[104].n_item) == (25, 20, 60)
    assert by[111].doc_start == 100_000


def test_both_joins_agree(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    a, b = (sorted(map(tuple, overlaps(docs, bench, broadcast_mb=m).collect())) for m in (32, -1))
    assert a == b and a


@pytest.mark.parametrize("broadcast_mb", [32, -1])
def test_two_matches_on_one_diagonal(spark, broadcast_mb):
    item = [f"w{k}" for k in range(75)]
    far = [*item[:5], *(f"x{k}" for k in range(40)), *item[45:]]
    two = [*item[:20], *(f"y{k}" for k in range(25)), *item[45:]]
    docs = spark.createDataFrame([(1, " ".join(far)), (2, " ".join(two)), (3, " ".join(far[:45]))], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = sorted(map(tuple, overlaps(docs, bench, broadcast_mb=broadcast_mb).collect()))
    assert found == [(1, 9, 30, 75, 45, 75, 45), (2, 9, 30, 75, 45, 75, 45)]


def test_empty_tables(spark, tables):
    docs, bench = tables
    for m in (32, -1):
        assert overlaps(docs.limit(0), bench, broadcast_mb=m).count() == 0
        assert overlaps(docs, bench.limit(0), broadcast_mb=m).count() == 0


def plain_overlaps(docs, items, least=12, share=0.75, identity=0.75):
    """All diagonals of all pairs, every place that a mask fits at, both ways as far as the sum grows."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))

    masks, found = D.masks_for({len(words(t)) for _, t in items}), {}
    for i, item_text in items:
        item = words(item_text)
        for d, text in docs:
            doc = words(text)
            for offset in range(-len(item) + 1, len(doc)):
                low, high = max(0, -offset), min(len(item), len(doc) - offset)
                same = [item[k] == doc[k + offset] for k in range(low, high)]
                for place in range(len(same)):
                    if not any(place + len(m) <= len(same) and all(same[place + k] for k, one in enumerate(m) if one == "1") for m in masks):
                        continue
                    right = list(accumulate(1 if x else -1 for x in same[place:]))
                    left = list(accumulate(1 if x else -1 for x in same[place::-1]))
                    stop, start = place + right.index(max(right)) + 1, place - left.index(max(left))
                    equal = sum(same[start:stop])
                    if equal >= min(least, math.ceil(share * len(item))) and equal >= identity * (stop - start):
                        row = (-equal, low + start + offset, low + start, len(item), low + stop + offset)
                        found[d, i] = min(found.get((d, i), row), row)
    return sorted((d, i, -r[0], r[3], r[1], r[4], r[2]) for (d, i), r in found.items())


@pytest.mark.parametrize("broadcast_mb", [32, -1])
def test_agrees_with_all_diagonals(spark, make_docs, broadcast_mb):
    rng = random.Random(12)
    word = lambda: rng.choice("a b c d e f".split())  # noqa: E731  few words: many chance meetings and repeats
    items = [(k, " ".join(word() for _ in range(rng.choice((5, 6, 7, 8, 9, 14, 30))))) for k in range(12)] + [(50, "a " * 40), (51, "a b " * 25), (52, None)]
    docs = [(k, " ".join(word() for _ in range(rng.choice((0, 4, 7, 20, 60))))) for k in range(25)] + [(90, "a " * 60), (91, "x " + "b a " * 30), (92, None)]
    docs += [(100 + k, f"{' '.join(word() for _ in range(9))} {t} z") for k, t in items if t]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(map(tuple, overlaps(make_docs(docs), bench, broadcast_mb=broadcast_mb).collect()))
    assert found == plain_overlaps(docs, items)


def test_repeated_tokens_are_quick():
    import pyarrow as pa

    text = pa.array(["same " * 800])
    index = D.Index([1], text)
    words = D.tokens(text)
    start = time.perf_counter()
    rows = [D.verify(words.hashes, index.texts[0], offset, index.masks, 12, 0.75, 0.75) for _, _, offset in index.diagonals(words).tolist()]
    assert time.perf_counter() - start < 1.0 and max(r[3] for r in rows if r) == 800
    periodic = pa.array(["yes no " * 10_000])
    start = time.perf_counter()
    assert len(D.Index([1], pa.array(["yes no " * 200])).diagonals(D.tokens(periodic))) > 10_000
    assert time.perf_counter() - start < 10
