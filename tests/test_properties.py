"""Property tests (hypothesis) for the reshaping operators."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from landflow.operators import shape as PR
from landflow.sources import pages as PG

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.text(alphabet="abcdefgh", min_size=1, max_size=3)
scalars = st.one_of(st.none(), st.booleans(), st.integers(-1000, 1000), st.text(max_size=5),
                    st.floats(allow_nan=False, allow_infinity=False, width=32))
values = st.recursive(scalars, lambda inner: st.one_of(st.lists(inner, max_size=3),
                                                       st.dictionaries(keys, inner, max_size=3)), max_leaves=6)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(st.integers(0, 99), max_size=5)), min_size=1, max_size=20))
def test_explode_rows_equal_sum_of_sizes(spark, lists):
    schema = "pid long, items array<struct<v:int>>"
    rows = [(i, None if lst is None else [(v,) for v in lst]) for i, lst in enumerate(lists)]
    df = spark.createDataFrame(rows, schema)
    out = PR.explode_children(df, "items", {"pid": "pid"})
    assert out.count() == sum(len(lst) for lst in lists if lst)
    got = sorted((r.pid, r.v) for r in out.collect())
    assert got == sorted((i, v) for i, lst in enumerate(lists) if lst for v in lst)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.tuples(st.one_of(st.none(), st.integers(0, 9)),
                                             st.one_of(st.none(), st.text(max_size=3)))), min_size=1, max_size=20))
def test_flatten_keeps_rows_and_values(spark, structs):
    schema = "id long, s struct<a:int, b:struct<c:string>>"
    rows = [(i, None if t is None else (t[0], (t[1],))) for i, t in enumerate(structs)]
    out = PR.flatten_struct(spark.createDataFrame(rows, schema), "s", "s_")
    got = {r.id: (r.s_a, r.s_b_c) for r in out.collect()}
    assert len(got) == len(structs)
    for i, t in enumerate(structs):
        assert got[i] == ((None, None) if t is None else t)


@SETTINGS
@given(st.lists(st.dictionaries(keys, values, max_size=6), min_size=1, max_size=6))
def test_conform_plus_rest_keep_every_key(spark, records):
    declared = ["a", "b", "c"]
    schema = StructType([StructField("a", StringType()), StructField("b", LongType()), StructField("c", StringType())])
    raws = [json.dumps(r) for r in records]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i long, raw string")
    out = PR.conform(df.withColumn("doc", F.parse_json("raw")), "doc", schema, keep=("i", "raw"))
    out = out.withColumn("rest", PR.rest_map(F.col("raw"), declared))
    for row in out.collect():
        rec = records[row.i]
        rest = json.loads(row.rest)
        assert set(rest) == set(rec) - set(declared)
        assert all(rest[k] == rec[k] or (isinstance(rec[k], float)) for k in rest)
        if isinstance(rec.get("b"), int) and not isinstance(rec.get("b"), bool):
            assert row.b == rec["b"]


@SETTINGS
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=60, unique=True), st.integers(1, 50))
def test_pack_unnest_round_trip(spark, ids, page_size):
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    pages = PG.pack_pages(df, F.lit("r"), F.floor(F.col("k") / page_size), F.struct("k"), PG.ODATA,
                          object_when_single=True)
    back = PG.items_as(PG.unnest_pages(pages, PG.ODATA), "struct<k:bigint>")
    assert sorted(r.k for r in back.collect()) == sorted(ids)


def test_spread_is_a_no_op_on_many_splits(spark):
    from landflow.session import spread

    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 20000), st.integers(0, 9)),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_running_total_sparse_pages(spark, rows):
    from landflow.operators.aggregates import running_total

    df = spark.createDataFrame(rows, "k string, p long, n long")
    got = {(r.k, r.p): r.t for r in running_total(df, "k", "p", "n", "t", block=16).collect()}
    for k, p, _ in rows:
        assert got[(k, p)] == sum(n for k2, p2, n in rows if k2 == k and p2 <= p)
