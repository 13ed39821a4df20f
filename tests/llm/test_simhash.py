import re

import numpy as np
import xxhash

from docpipe.llm import simhash
from docpipe.llm.simhash import fingerprint, hexadecimal, near_duplicates, near_links


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(ids, fps):
    left, best = set(range(len(fps))), {}
    while left:
        stack, seen = [left.pop()], []
        while stack:
            i = stack.pop()
            seen.append(i)
            near = {j for j in left if (fps[i] ^ fps[j]).bit_count() <= 2}
            left -= near
            stack += near
        named = [ids[i] for i in seen if ids[i] is not None]
        for i in seen:
            best[i] = min(named, default=None)
    return best


def test_fingerprints(prose):
    for text in ("", " \n", "One", "one TWO", "a b c", prose(500), "é É x y", "the " * 50, prose(40_000)):
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_agrees_with_brute_force(spark, make_docs, prose):
    rows = [(i, prose(20 + i % 9)) for i in range(60)]
    base = prose(400)
    rows += [(100 + i, base + f" tail{i}") for i in range(40)] + [(200 + i, base) for i in range(5)]
    rows += [(300, None), (301, ""), (302, "\t"), (303, "One"), (304, "oNE"), (None, base), (None, "only here"), (100, base + " tail0")]
    found = near_duplicates(make_docs(rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    best = reach([i for i, _ in rows], fps)
    expected = sorted((str(i), fps[k], str(best[k])) for k, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in found) == expected


def test_crowded_lists_lose_no_link(spark):
    rng = np.random.default_rng(3)
    fps = {int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 60)}
    for c in list(fps)[:4]:
        for _ in range(50):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= (1 << int(b)) - (1 << 64 if b == 63 else 0)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    unsigned = [x % (1 << 64) for x in fps]
    want = reach(fps, unsigned)
    for limit in (2, 8, 1000):
        parent = {x: x for x in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in near_links(df, limit).collect():
            a, b = root(r.a), root(r.b)
            parent[max(a, b)] = min(a, b)
        assert [root(x) for x in fps] == [want[k] for k in range(len(fps))]


def test_hexadecimal_and_empty_table(spark, make_docs):
    df = spark.createDataFrame([(-1,), (0,), (255,)], "fp long")
    assert [r[0] for r in df.select(hexadecimal(df.fp)).collect()] == ["f" * 16, "0" * 16, "0" * 14 + "ff"]
    assert near_duplicates(make_docs([])).count() == 0


def test_tallies_decide(spark, monkeypatch):
    """A pair two bits apart in two bytes meets in 15 lists, just the guaranteed minimum."""
    base = 0x1122334455667788
    rows = [base, base ^ (1 << 3) ^ (1 << 60), base ^ 1 ^ (1 << 20) ^ (1 << 50), 5]
    df = spark.createDataFrame([(x,) for x in rows], "fp long")
    assert [(r.a, r.b) for r in near_links(df).collect()] == [(min(rows[:2]), max(rows[:2]))]
    monkeypatch.setattr(simhash, "SHARED_BYTES", 7)
    assert near_links(df).count() == 0
    assert len(simhash.positions()) == 70


def test_many_rows_without_text_or_id(make_docs, prose):
    rows = [(None, prose(30)) for _ in range(30)] + [(i, None if i % 2 else "") for i in range(300)] + [(None, None)] * 60
    found = near_duplicates(make_docs(rows)).collect()
    assert len(found) == len(rows) and {r.component_id for r in found if r.fp == 0} == {0}


def test_index_is_never_broadcast(spark, monkeypatch):
    plans = []
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr("docpipe.llm.simhash.cut", plan)
    plan(near_links(spark.range(300).selectExpr("id * id as fp"), 8))
    assert len(plans) == 2 and all("Join" in p and "Broadcast" not in p for p in plans)
