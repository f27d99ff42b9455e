import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landflow.functions import scalars as SF


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_truthy_python_rules(spark):
    cases = {'{"f":true}': True, '{"f":false}': False, '{"f":"false"}': True, '{"f":""}': False,
             '{"f":0}': False, '{"f":0.0}': False, '{"f":2}': True, '{"f":[]}': False, '{"f":[0]}': True,
             '{"f":{}}': False, '{"f":{"a":1}}': True, '{"f":null}': False, '{}': False}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r.raw: r.t for r in df.select("raw", SF.truthy(F.try_variant_get(F.parse_json("raw"), "$.f", "variant"))
                                          .alias("t")).collect()}
    assert got == cases


def test_text_to_bool(spark):
    cases = {'"TRUE"': "true", '"True"': "true", '"no"': "false", '""': None, "true": "true", "false": "false",
             "null": None, "1": "1"}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r.raw: r.t for r in df.select("raw", SF.text_to_bool(F.parse_json("raw")).alias("t")).collect()}
    assert got == cases


def test_join_list(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],), (["a", "b"],)], "l array<string>")
    assert [r.x for r in df.select(SF.join_list("l").alias("x")).collect()] == [None, "", "a", "a, b"]
    s = spark.createDataFrame([("keep",)], "l string")
    assert s.select(SF.join_list("l", dtype=s.schema["l"].dataType).alias("x")).first().x == "keep"


def test_times(spark):
    assert _one(spark, SF.strip_zone(F.lit("2024-01-01T10:00:00+05:30"))) == dt.datetime(2024, 1, 1, 10, 0)
    assert _one(spark, SF.strip_zone(F.lit("garbage"))) is None
    assert _one(spark, SF.to_time_or_null(F.lit("2024-01-02 03:04:05"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert _one(spark, SF.to_time_or_null(F.lit("02/01/2024"), "dd/MM/yyyy")) == dt.datetime(2024, 1, 2)
    assert _one(spark, SF.to_time_or_null(F.lit("nope"), "dd/MM/yyyy")) is None
    assert _one(spark, SF.epoch_seconds(F.lit("2024-06-01 12:00:00").cast("timestamp_ntz"))) == 1717243200


def test_run_day_and_bounds(spark):
    now = F.lit("2024-03-01 00:30:00").cast("timestamp_ntz")
    assert _one(spark, SF.run_day(F.lit("2024-02-10"), now)) == "2024-02-10"
    assert _one(spark, SF.run_day(F.lit("10/02/2024"), now)) == "2024-02-29"
    assert _one(spark, SF.run_day(F.lit(None).cast("string"), now)) == "2024-02-29"
    start, end = SF.day_bounds(F.lit("2024-02-10"))
    assert _one(spark, start) == "'2024-02-10T00:00:00.000Z'"
    assert _one(spark, end) == "'2024-02-10T23:59:59.000Z'"


def test_nullable_bool_and_object_text(spark):
    df = spark.createDataFrame([("true",), ("FALSE",), ("maybe",), (None,)], "s string")
    assert [r.b for r in df.select(SF.nullable_bool("s").alias("b")).collect()] == [True, False, None, None]
    st = spark.createDataFrame([((1, "a"), [1, 2], 5)], "o struct<x:int,y:string>, l array<int>, n int")
    r = st.select(*[SF.object_to_text(c, st.schema[c].dataType).alias(c) for c in st.columns]).first()
    assert (r.o, r.l, r.n) == ('{"x":1,"y":"a"}', "[1,2]", "5")


def test_null_if_not_object(spark):
    vals = ['{"a":1}', "{}", "[]", "[1]", '"x"', "oops", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r.x for r in df.select(SF.null_if_not_object("s").alias("x")).collect()] == \
        ['{"a":1}', None, None, None, None, None, None]
    st = StructType.fromDDL("a int, b string")
    sdf = spark.createDataFrame([((None, None),), ((1, None),), (None,)], "o struct<a:int,b:string>")
    got = [r.x for r in sdf.select(SF.null_if_not_object("o", st).alias("x")).collect()]
    assert got[0] is None and got[1] is not None and got[2] is None


def test_to_time_or_null_ignores_session_zone(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        got = _one(spark, SF.to_time_or_null(F.lit("10/03/2024 02:30:00"), "dd/MM/yyyy HH:mm:ss"))
        assert got == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set(key, before)
