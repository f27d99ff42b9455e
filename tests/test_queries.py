"""Every registered query against its SQL in DuckDB, on the smallest data."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows), sorted(cols)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return c


#: Queries of the reference's own operators; the others have tests beside them.
OWN = sorted(n for n in E.queries() if n.startswith("q_"))


def test_every_own_query_has_sql():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    got, gcols = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want, wcols = _rows([d[0] for d in res.description], res.fetchall())
    assert gcols == wcols
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["LoadDate", "rows"] and len(rows) > 0


TIME_QUERIES = ["q_strip_zone", "q_to_time_or_null", "q_sink_cast", "q_epoch_seconds", "q_stamp_run",
                "q_run_day", "q_where_day", "q_replace_partition", "q_tp_access"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_time_queries_in_another_session_zone(spark, con, name):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        test_query_matches_sql(spark, con, name)
    finally:
        spark.conf.set(key, before)
