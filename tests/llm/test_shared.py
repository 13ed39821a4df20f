import re

import numpy as np
from pyspark.sql import functions as F
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpipe.llm import shared


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\xa0éß", max_size=30)), max_size=6))
def test_words_agree_with_the_pattern(texts):
    words = shared.Words(pa.array(texts, pa.string()), lower=False)
    for i, t in enumerate(texts):
        expected = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        spans = slice(words.first[i], words.first[i + 1])
        assert [words.buf[a:b].tobytes() for a, b in zip(words.starts[spans], words.ends[spans])] == expected
        assert words.hashes[spans].tolist() == [shared.word_hash(w) for w in expected]


def test_planes_round_trip_and_slices():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (shared.unplane(shared.planes(keys)) == keys).all()
    parts = shared.slices(keys, 7)
    assert [k for _, s in parts for k in keys[s].tolist()] == keys.tolist()
    assert [b for b, _ in parts] == sorted({(int(k) >> 32) * 7 >> 32 for k in keys})
    assert shared.slices(keys[:0], 7) == [] and len(shared.slices(keys[:3], 1 << 20)) == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_agree_with_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-50, 200, (160, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, k) for k in range(6000, 6080)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b and root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    found = shared.components(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()
    assert len(found) == len(linked)
    assert {r.node: r.component for r in found} == {x: root(x) for x in linked}


def test_components_of_nothing(spark):
    assert shared.components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_digest_limits_stay_within_budget(spark):
    rows = [(i, "a" if i % 3 else "b", 100) for i in range(3000)]
    slim = spark.createDataFrame(rows, "_id long, _kind string, _size long").withColumn("_at", shared.digest_at(F.col("_id")))
    limit, n = shared.digest_limits(slim, 20_000)
    slim = slim.withColumn("at", F.col("_at"))
    for kind in "ab":
        taken = slim.where((slim._kind == kind) & (slim["at"] < limit[kind])).count()
        assert 150 <= taken <= 200
    assert n == {"a": 2000, "b": 1000}


def test_digest_limits_count_equal_rows_once(spark):
    rows = [(None, "a", 900)] * 500 + [(i, "a", 100) for i in range(300)]
    slim = spark.createDataFrame(rows, "_id long, _kind string, _size long").withColumn("_at", shared.digest_at(F.col("_id")))
    limit, n = shared.digest_limits(slim, 100_000)
    assert n == {"a": 800} and limit["a"] > 0.99
