from pathlib import Path

import numpy as np
import pytest

from docpipe.llm.embedding_dedup import block_edges, near_duplicates, rotation


def brute(rows, t=0.95):
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {k: set() for k in range(len(rows))}
    for n, i in enumerate(good):
        for j in good[n + 1 :]:
            a, b = (np.array(rows[k][1], float) for k in (i, j))
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= t:
                near[i].add(j)
                near[j].add(i)
    out, left = {}, set(near)
    while left:
        stack, seen = [left.pop()], []
        while stack:
            k = stack.pop()
            seen.append(k)
            stack += near[k] & left
            left -= near[k]
        for k in seen:
            out[k] = (rows[k][0], len(near[k]), min(rows[j][0] for j in seen))
    return sorted((*v, v[0] == v[2]) for v in out.values())


@pytest.mark.parametrize("dim", [64, 3, 20])
def test_agrees_with_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [rng.normal(size=dim) for _ in range(150)]
    for k in range(6):
        rows += [rows[k] + rng.normal(size=dim) * s for s in np.linspace(0.05, 0.5, 25)]
    rows += [rows[0] * 3, rows[1], rows[1]]
    table = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    n = len(table)
    table += [(n, None), (n + 1, []), (n + 2, [0.0] * dim), (n + 3, [None] * dim), (n + 4, [float("nan")] * dim), (n + 5, [float("inf")] + [1.0] * (dim - 1)), (n + 6, [1.0] * (dim + 1)), (n + 7, [1.0] * (dim + 1))]
    df = spark.createDataFrame([(*r, 1, 2) for r in table], "vec_id long, embedding array<float>, dim int, cls long")
    assert sorted(map(tuple, near_duplicates(df).collect())) == brute(table)


def test_crowded_cells_are_split(spark, monkeypatch):
    from docpipe.llm import embedding_dedup as e

    plain = e.near_links
    monkeypatch.setattr(e, "near_links", lambda classes, t: plain(classes, t, crowd=7))
    rng = np.random.default_rng(5)
    c = rng.normal(size=16)
    table = [(i, [float(x) for x in c + rng.normal(size=16) * 0.1]) for i in range(60)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, near_duplicates(df).collect())) == brute(table)


def test_rotation_and_blocks():
    assert np.allclose(rotation(24) @ rotation(24).T, np.eye(24))
    assert block_edges(64)[-1] == (56, 64) and block_edges(5) == [(0, 5)]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tables_written_grow_with_the_vectors_only(spark, monkeypatch):
    from docpipe.llm import embedding_dedup as e

    written, cut = [], e.cut
    monkeypatch.setattr(e, "cut", lambda df: written.append(cut(df)) or written[-1])
    rng = np.random.default_rng(8)
    n, dim = 3000, 64
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, dim)).astype(np.float32))], "vec_id long, embedding array<float>")
    assert near_duplicates(df).where("n_links = 0 and kept").count() == n
    sizes = [sum(Path(f.removeprefix("file:")).stat().st_size for f in t.inputFiles()) for t in written]
    assert sum(t.count() for t in written) < 2 * n and sum(sizes) < 3 * 4 * n * dim


def test_pairs_of_tiles_are_no_shuffle_and_no_broadcast(spark):
    from docpipe.llm.embedding_dedup import near_links

    classes = spark.createDataFrame([(1, 2, 1, [1.0, 2.0])], "cls long, dim int, weight long, embedding array<double>")
    plan = near_links(classes, 0.95)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_links_across_tiles(spark):
    """A chain through many small tiles, a dense cluster, equal vectors and two lengths."""
    from docpipe.llm import embedding_dedup as e

    turn = np.arange(40) * 0.3  # neighbours have a cosine of 0.955, others less
    rows = [[float(np.cos(x)), float(np.sin(x)), 0.0] for x in turn[:20]] + [[0.0, 0.0, 1.0 + k % 3] for k in range(30)]
    rows += [[1.0, 0.01 * k, 0.0, 0.0] for k in range(25)] + [[0.0, -0.0, 2.0], [-0.0, 0.0, 2.0]]
    table = list(enumerate(rows))[::-1]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    want, plain = brute(table), e.near_links
    for crowd in (1, 3, 4096):
        e.near_links = lambda classes, t: plain(classes, t, crowd=crowd)
        try:
            assert sorted(map(tuple, near_duplicates(df).collect())) == want
        finally:
            e.near_links = plain
