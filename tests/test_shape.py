import json

import pytest
from pyspark.sql import functions as F

from landflow.operators import shape as PR


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    assert PR.clean_columns(df).columns == ["a_b", "c_d"]
    clash = spark.createDataFrame([(1, 2)], "`a.b` int, `a b` int")
    with pytest.raises(ValueError):
        PR.clean_columns(clash)


def test_keep_and_drop(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    assert PR.keep_columns(df, ["id", "missing"]).columns == ["id"]
    filled = PR.keep_columns(df, ["id", "missing"], fill_missing=True)
    assert filled.columns == ["id", "missing"] and filled.first().missing is None
    assert PR.drop_columns(df, ["name", "absent"]).columns == ["id"]


def test_flatten_struct_rows_stay_aligned(spark):
    schema = "id int, d struct<a:int, b:struct<c:string>, l:array<int>>"
    df = spark.createDataFrame([(1, None), (2, (None, None, None)), (3, (7, ("x",), [1, 2]))], schema)
    out = PR.flatten_struct(df, "d", "d_")
    assert out.columns == ["id", "d_a", "d_b_c", "d_l"]
    rows = {r.id: r for r in out.collect()}
    assert rows[1].d_a is None and rows[2].d_a is None
    assert rows[3].d_a == 7 and rows[3].d_b_c == "x" and rows[3].d_l == [1, 2]
    assert "Exchange" not in _plan(out)
    one = PR.flatten_one_level(df, "d", "d_")
    assert one.columns == ["id", "d_a", "d_b", "d_l"]
    text = spark.createDataFrame([(1, None)], "id int, d string")
    assert PR.flatten_struct(text, "d").columns == ["id"]


def test_explode_children_keys_win(spark):
    schema = "ws_id string, ws_name string, items array<struct<id:string, ws_id:string>>"
    df = spark.createDataFrame([("w1", "one", [("i1", "wrong"), ("i2", None)]), ("w2", "two", []), ("w3", "three", None)],
                               schema)
    out = PR.explode_children(df, "items", {"ws_id": "ws_id", "workspace_name": "ws_name"})
    assert out.columns == ["id", "ws_id", "workspace_name"]
    assert sorted(tuple(r) for r in out.collect()) == [("i1", "w1", "one"), ("i2", "w1", "one")]
    assert "Exchange" not in _plan(out)
    many = PR.explode_many(df, {"items": "children", "absent": "none"}, {"ws_id": "ws_id"})
    assert list(many) == ["children"]


def test_conform_wrong_type_missing_nested(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("Id", StringType()), StructField("RecordType", IntegerType()),
                         StructField("Info", StringType()), StructField("Gone", StringType())])
    df = spark.createDataFrame([('{"Id":"a","RecordType":"bad","Info":{"x":[1,2]}}',), ('{"Id":"b","RecordType":3}',)],
                               "raw string").select(F.parse_json("raw").alias("doc"))
    rows = {r.Id: r for r in PR.conform(df, "doc", schema).collect()}
    assert rows["a"].RecordType is None and rows["a"].Info == '{"x":[1,2]}' and rows["a"].Gone is None
    assert rows["b"].RecordType == 3


def test_rest_map_keeps_types_and_order(spark):
    raw = '{"Id":"a","z":5,"b":true,"n":null,"l":[1,{"q":2}],"o":{"k":"v"},"u":"é"}'
    df = spark.createDataFrame([(raw,)], "raw string")
    text = df.select(PR.rest_map(F.col("raw"), ["Id"]).alias("x")).first().x
    assert list(json.loads(text).items()) == [("z", 5), ("b", True), ("n", None), ("l", [1, {"q": 2}]),
                                              ("o", {"k": "v"}), ("u", "é")]
    keys = set(json.loads(raw))
    assert set(json.loads(text)) | {"Id"} == keys  # conform + rest keep every key


def test_stamp_run_kinds(spark):
    df = spark.range(1)
    r = PR.stamp_run(PR.stamp_run(df, "2024-06-01 12:00:00", "epoch"), "2024-06-01 12:00:00", "load_date", "d").first()
    assert r.extraction_timestamp == 1717243200 and r.d == "2024-06-01"
    with pytest.raises(ValueError):
        PR.stamp_run(df, "2024-06-01 12:00:00", "weekly")
