import pytest
from pyspark.sql import functions as F

from landflow.session import scratch_path, unique_name
from landflow.sinks import tables as SK


@pytest.fixture()
def db(spark):
    name = unique_name("lf_test")
    SK.ensure_schema(spark, name, scratch_path(spark, name))
    return name


def test_replace_partition_idempotent(spark, db):
    t = f"{db}.ev"
    df = spark.createDataFrame([(i, float(i), f"2024-01-0{1 + i % 3}") for i in range(30)], "id long, v double, d string")
    SK.replace_partition(df, t, "d")
    again = df.where("d = '2024-01-02'").withColumn("v", F.col("v") * 10)
    SK.replace_partition(again, t, "d")
    once = sorted(tuple(r) for r in spark.read.table(t).collect())
    SK.replace_partition(again, t, "d")
    assert sorted(tuple(r) for r in spark.read.table(t).collect()) == once
    SK.replace_partition(again.limit(0), t, "d")
    assert sorted(tuple(r) for r in spark.read.table(t).collect()) == once
    assert spark.read.table(t).count() == 30
    day = spark.read.table(t).where("d = '2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-02" in plan.split("PartitionFilters")[1]


def test_replace_partition_in_static_session(spark, db):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        t = f"{db}.st"
        df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
        SK.replace_partition(df, t, "p")
        SK.replace_partition(spark.createDataFrame([(9, "a"), (7, "b")], "v int, p string"), t, "p", value="a")
        assert sorted(tuple(r) for r in spark.read.table(t).collect()) == [(2, "b"), (9, "a")]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)


def test_full_refresh_strict_and_replace(spark, db):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert SK.write_full_refresh(a, f"{db}.t", "strict") == 1
    b = spark.createDataFrame([(1, 2.0)], "k int, w double")
    with pytest.raises(ValueError):
        SK.write_full_refresh(b, f"{db}.t", "strict")
    assert SK.write_full_refresh(b, f"{db}.t", "replace") == 1
    assert spark.read.table(f"{db}.t").columns == ["k", "w"]


def test_empty_policy_and_save_tables(spark, db):
    empty = spark.createDataFrame([], "k int")
    full = spark.createDataFrame([(1,)], "k int")
    assert SK.apply_empty_policy(full, "skip") == "write"
    assert SK.apply_empty_policy(empty, "skip") == "skip"
    assert SK.apply_empty_policy(empty, "write_empty") == "write_empty"
    with pytest.raises(SK.EmptyInput):
        SK.apply_empty_policy(empty, "stop")
    out = SK.save_tables({"a": full, "b": empty}, db, policy="skip", shared=(full,))
    assert out == {"a": 1, "b": None}
    out = SK.save_tables({"b": empty}, db, policy="write_empty")
    assert out == {"b": 0} and spark.read.table(f"{db}.b").columns == ["k"]


def test_sink_cast_types(spark):
    df = spark.createDataFrame([((1, "a"), [1], True, None)], "o struct<x:int,y:string>, l array<int>, b boolean, n void") \
        .withColumn("t", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    out = SK.sink_cast(df)
    types = dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)
    assert types == {"o": "string", "l": "string", "b": "boolean", "n": "string", "t": "timestamp_ntz"}
    r = out.first()
    assert r.o == '{"x":1,"y":"a"}' and r.l == "[1]" and r.b is True and r.n is None
    assert str(r.t) == "2024-01-01 10:00:00"


def test_release_frees_cached_sides(spark):
    from landflow import session as S

    side = S.bounded_broadcast(spark.range(10))
    assert side.count() == 10 and S._CACHED
    m = S.materialize(spark.range(5), "rel")
    assert m.count() == 5
    S.release(drop_files=True)
    assert not S._CACHED and not S._WRITTEN
    assert spark.range(10).storageLevel.useMemory is False


def test_bounded_broadcast_respects_bounds(spark):
    from landflow import session as S

    small = S.bounded_broadcast(spark.range(100))
    assert "BroadcastHashJoin" in spark.range(1000).join(small, "id")._jdf.queryExecution().executedPlan().toString()
    big = S.bounded_broadcast(spark.range(100), max_rows=10)
    assert big.storageLevel.useMemory is False  # released, no hint
    wide = S.bounded_broadcast(spark.range(100).selectExpr("id", "repeat('x', 10) as s"), max_bytes=100)
    assert wide.storageLevel.useMemory is False
    S.release()


def test_a_failed_set_leaves_every_table(spark, db):
    old = spark.createDataFrame([(1,)], "k int")
    SK.save_tables({"a": old, "b": old, "c": old}, db)
    new = spark.createDataFrame([(2,)], "k int")
    broken = new.withColumn("k", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(Exception, match="gone"):
        SK.save_tables({"a": new, "b": new, "c": broken}, db)
    with pytest.raises(SK.EmptyInput):
        SK.save_tables({"a": new, "b": new.limit(0)}, db, policy="stop")
    with pytest.raises(ValueError):
        SK.save_tables({"a": new, "b": new.withColumn("k", F.lit("x"))}, db, schema_mode="strict")
    assert [spark.read.table(f"{db}.{t}").first().k for t in "abc"] == [1, 1, 1]
    assert sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary) == ["a", "b", "c"]


def test_a_save_that_dies_among_its_renames_is_finished(spark, db, monkeypatch):
    old, new = (spark.createDataFrame([(k,)], "k int") for k in (1, 2))
    SK.save_tables({"a": old, "b": old}, db)
    whole = SK.finish_save
    calls = []

    def dies(s, schema):
        calls.append(schema)
        if len(calls) < 2:
            return whole(s, schema)  # the settling at the start
        s.sql(f"DROP TABLE {db}.a")  # the run ends within the first rename
        raise KeyboardInterrupt

    monkeypatch.setattr(SK, "finish_save", dies)
    with pytest.raises(KeyboardInterrupt):
        SK.save_tables({"a": new, "b": new}, db)
    monkeypatch.undo()
    assert SK.finish_save(spark, db) == ["a", "b"] and SK.finish_save(spark, db) == []
    assert [spark.read.table(f"{db}.{t}").first().k for t in "ab"] == [2, 2]
    assert sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary) == ["a", "b"]
