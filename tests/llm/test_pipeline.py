import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from docpipe.llm import near_copies, shared, simhash
from docpipe.llm.decontaminate import overlaps
from docpipe.llm.toxicity import score_toxicity

from .test_near_copies import groups, shingles
from .test_simhash import plain_fingerprint
from .test_substring_dedup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.toPandas())
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        out.append(docs.toPandas())
    return out


def test_each_stage_agrees_with_plain_python(spark, results):
    start, toxic, near, passages, clean, mixed = results
    scores = score_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).toPandas().set_index("doc_id")
    assert set(toxic.doc_id) == {i for i in start.doc_id if scores.predicted[i] == 0}

    ids = list(toxic.doc_id)
    fps, sets = [plain_fingerprint(t) for t in toxic.text], [shingles(t) for t in toxic.text]
    # fingerprints within two bits, or five-word shingles with a Jaccard similarity of 0.8 or more
    linked = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2 or (sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    best = groups(ids, [(ids[a], ids[b]) for b in range(len(ids)) for a in range(b) if linked(a, b)])
    assert set(near.doc_id) == set(best.values()) and len(near) == near.doc_id.nunique()

    expected = {int(i): (n, kept) for i, _, n, kept in brute(list(zip(near.doc_id.tolist(), near.text)))}
    texts = dict(zip(near.doc_id, near.text))
    assert dict(zip(passages.doc_id, passages.text)) == {i: kept if n else texts[i] for i, (n, kept) in expected.items() if not n or kept}
    assert all(n == len(t) for n, t in zip(passages.n_chars, passages.text))

    hit = {r.doc_id for r in overlaps(spark.createDataFrame(passages), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert set(clean.doc_id) == set(passages.doc_id) - hit

    assert list(mixed.doc_id.sort_values()) == list(clean.doc_id.sort_values())
    assert abs(mixed.taken.sum() - 1.5 * mixed["size"].sum()) < 0.3 * mixed["size"].sum()
    for frame in results[:-1]:
        assert list(frame.columns) == list(start.columns)


def test_run_is_the_stages_in_turn(spark, results):
    key = ["doc_id", "taken"]
    assert sorted(map(tuple, P.run(spark, SF).select(key).collect())) == sorted(map(tuple, results[-1][key].to_numpy().tolist()))


def test_rows_with_nulls_and_repeats(spark, prose):
    same = prose(60)
    rows = [(1, same, "en", "s", 1), (1, same, "en", "s", 1), (2, same + " x", None, None, None), (None, prose(40), "en", "s", 1), (None, None, None, None, None), (3, None, None, "s", 0), (4, "", "en", None, 0), (5, prose(30), "de", "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "near duplicates":
            left = [r.doc_id for r in docs.collect()]
            assert left.count(1) == 1 and {5} <= set(left)
    assert docs.where(F.col("doc_id") == 5).count() == 1


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_null_ids_are_decontaminated(spark, prose):
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, passage), (None, prose(40)), (1, prose(40)), (2, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {(r.doc_id, r.text) for r in P.drop_contaminated(spark, docs, SF).collect()}
    assert left == set(rows[1:3])


def test_fingerprint_index_of_near_duplicates_is_never_broadcast(spark, monkeypatch):
    plans = []
    cut = simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    docs = spark.createDataFrame([(k, f"text {k // 2} of some words") for k in range(40)], "doc_id long, text string")
    simhash.duplicate_links(docs).collect()
    joins = [p for p in plans if "Generate" in p and "Join" in p]
    assert joins and not any("Broadcast" in p for p in joins)


def test_near_duplicates_broadcast_nothing_that_grows(spark, monkeypatch, prose):
    base = [prose(60) for _ in range(12)]
    texts = base + base[:4] + [t + " end" for t in base[4:8]] + [prose(20) + " " + t for t in base]
    docs = shared.cut(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    whole = sorted(map(tuple, P.drop_near_duplicates(spark, docs, SF).collect()))
    plans = []

    def seen(df, cut=shared.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(shared, "MOST_SENT", -1, raising=False)
    for module in (near_copies, shared, simhash, P):
        monkeypatch.setattr(module, "cut", seen)
    kept = P.drop_near_duplicates(spark, docs, SF)
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, kept.collect())) == whole and len(whole) < len(texts)
    assert sum("Join" in p for p in plans) >= 12 and not any("Broadcast" in p for p in plans)
