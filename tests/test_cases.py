import duckdb
import pytest
from pyspark.sql import functions as F

from docpipe.plans import rendered
from docpipe.plans.cases import CASES
from docpipe.plans.rendered import RENDERED


@pytest.mark.parametrize("name", sorted(CASES))
def test_case(spark, name):
    function, rows = CASES[name]
    df = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], "k int, input string")
    found = {r.k: r.value for r in df.select("k", function(F.col("input")).alias("value")).collect()}
    assert [found[k] for k in range(len(rows))] == [e for _, e in rows]


@pytest.mark.parametrize("name", sorted(CASES))
def test_null_input(spark, name):
    function, _ = CASES[name]
    df = spark.createDataFrame([(None,)], "input string")
    df.select(function(F.col("input")).alias("value")).collect()


def test_rendered_queries_are_functions_of_cases():
    assert set(RENDERED) <= set(CASES) and len(set(CASES) - set(RENDERED)) <= 15


@pytest.mark.parametrize("name", ["date_yy_pivot", "ssn_match", "name_match", "mrn_extract"])
def test_rendered_values_agree_with_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    got = {r.o_orderkey: r.value for r in rendered.query(name)(spark, folder).collect()}
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sql = con.sql(rendered.oracle(name))
    at = sql.columns.index("o_orderkey")
    assert got == {r[at]: r[1 - at] for r in sql.fetchall()} and len(set(got.values())) > 20


def test_payload_decode_has_every_order_and_every_outcome(spark, tmp_path):
    spark.createDataFrame([(k, None) for k in range(8)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.o_orderkey: r.value for r in rendered.query("payload_decode")(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert got == dict(con.sql(f"SELECT o_orderkey, value FROM ({rendered.oracle('payload_decode')})").fetchall())
    assert sorted(got) == list(range(8)) and set(got.values()) == {expected for _, expected in CASES["payload_decode"][1]}
