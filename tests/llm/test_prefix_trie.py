import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from docpipe.llm.prefix_trie import prefix_trie, spliced, stitched_trie, turns_in_order
from docpipe.llm.queries import ORACLE_SQL, op11_prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def expected(table):
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [r[3:] for r in sorted(rows)] for c, rows in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(c / 100) * 100
        base = c - base
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (members[n][0], len(n), -1 if not n else members[n[:-1]][0], len(members[n]), len(children[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n in members
    )


def got(trie):
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.select(*COLUMNS).collect())


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "conv_id long, turn long, role string, text string, node string, depth int, above binary")


@pytest.fixture(scope="module")
def table():
    rng = random.Random(9)
    first = [("system", "Be brief."), ("user", "Hello é"), ("user", None), (None, "")]
    rows = []
    for c in [*range(-120, 0, 7), *range(0, 330), 5000, 5001, 70_007]:
        path = [rng.choice(first[:2] if rng.random() < 0.8 else first)]
        path += [(rng.choice(("user", "assistant")), rng.choice(("yes", "no", "why?", "x" * 40))) for _ in range(rng.choice((0, 1, 2, 4, 9)))]
        rows += [(c, rng.choice((k, k, k, None)) if c % 5 == 0 else k, *turn) for k, turn in enumerate(path)]
    rows += rows[:30]  # repeated rows are turns of their own
    rows += [(c, k, "user", f"copied {k}") for c in range(900, 980) for k in range(3)]  # equal conversations
    rows += [(c, k, "user", f"long {k}") for c in (1100, 1101) for k in range(300)]
    rows += [(None, 0, "user", "of nobody")]
    return rows


@pytest.mark.parametrize("most", [None, 3, 64, 10**6])
def test_agrees_with_plain_python(spark, table, most):
    turns = spliced(turns_in_order(make(spark, table)), (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6).cast("int"), F.col("conv_id") - F.col("conv_id") % 100, 5)
    assert got(prefix_trie(turns, most)) == expected(table)


def test_empty_table_and_turnless_conversations(spark):
    assert got(stitched_trie(make(spark, []))) == []
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    assert got(stitched_trie(make(spark, [(alone, 0, "user", "a"), (alone, 1, "user", "b")]))) == [(alone, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_query_agrees_with_plain_python_and_sql(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    query = op11_prefix_trie(spark, folder)
    assert query.columns == list(COLUMNS)
    assert got(query) == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    sql = con.sql(ORACLE_SQL["op11_prefix_trie"])
    at = [sql.columns.index(c) for c in COLUMNS]
    assert sorted(tuple(-1 if r[k] is None else r[k] for k in at) for r in sql.fetchall()) == expected(rows)
