import json

import pytest
from pyspark.sql import functions as F

from landflow.plans import pipelines as TP
from landflow.plans.contracts import ACTIVITY_SCHEMA
from landflow.session import scratch_path, unique_name
from landflow.sinks import tables as SK
from landflow.sources.pages import PAGE_SCHEMA


def _page(key, no, records, last, status=200):
    body = {"activityEventEntities": records, "lastResultSet": last}
    if not last:
        body["continuationUri"] = f"/next/{no + 1}"
    return (key, no, status, json.dumps(body))


def test_activity_rows_rules(spark):
    recs = [
        {"Id": "1", "CreationTime": "2024-01-15T23:59:59.500", "IsSuccess": "false", "RecordType": 7,
         "HasFullReportAttachment": "TRUE", "n": 5, "Extra": {"a": [1]}},
        {"Id": "2", "CreationTime": "2024-01-15T10:00:00", "IsSuccess": False, "RecordType": "x",
         "HasFullReportAttachment": ""},
        {"Id": "3", "CreationTime": "2024-01-16T00:00:00"},
    ]
    pages = spark.createDataFrame([_page("d", 0, recs, True), _page("d", 1, [{"Id": "late"}], True)], PAGE_SCHEMA)
    rows = {r.Id: r for r in TP.activity_rows(pages, "2024-06-01 12:00:00", day="2024-01-15").collect()}
    assert set(rows) == {"1", "2", "3"}  # every event of the day's chain, whatever its clock; no page after the last
    assert {r.LoadDate for r in rows.values()} == {"2024-01-15"}
    assert rows["1"].IsSuccess is True and rows["2"].IsSuccess is False
    assert rows["1"].RecordType == 7 and rows["2"].RecordType is None
    assert rows["1"].HasFullReportAttachment == "true" and rows["2"].HasFullReportAttachment is None
    assert json.loads(rows["1"].AdditionalInfo) == {"Extra": {"a": [1]}, "n": 5}
    assert rows["1"].AdditionalInfo.index('"n"') < rows["1"].AdditionalInfo.index("Extra")  # record order
    assert rows["1"].LoadDate == "2024-01-15"
    out_cols = [f.name for f in ACTIVITY_SCHEMA.fields] + ["LoadDate", "ProcessingTimestamp"]
    assert TP.activity_rows(pages, "2024-06-01 12:00:00").columns == out_cols


def test_failed_chain_does_not_replace_stored_day(spark):
    db = unique_name("lf_act")
    SK.ensure_schema(spark, db, scratch_path(spark, db))
    t = f"{db}.activity_events"
    good = spark.createDataFrame([_page("day", 0, [{"Id": "a", "CreationTime": "2024-01-15T01:00:00"}], True)],
                                 PAGE_SCHEMA)
    assert TP.load_activity(good, t, "2024-06-01 12:00:00", day="2024-01-15") == 1
    broken = spark.createDataFrame([_page("day", 0, [{"Id": "b", "CreationTime": "2024-01-15T02:00:00"}], False),
                                    ("day", 1, 500, "rate limited")], PAGE_SCHEMA)
    with pytest.raises(SK.EmptyInput):
        TP.load_activity(broken, t, "2024-06-01 12:00:00", day="2024-01-15")
    assert [r.Id for r in spark.read.table(t).collect()] == ["a"]


def test_access_tables_only_on_request(spark):
    empty = spark.createDataFrame([], PAGE_SCHEMA)
    assert TP.build_access(empty, empty, empty, empty, {}, "2024-06-01 12:00:00", include_access=False) == {}


def test_gateway_children_pair_by_key(spark):
    gw = spark.createDataFrame([("gateways", 0, 200, json.dumps({"value": [{"name": "no id"}, {"id": "g1"}]}))],
                               PAGE_SCHEMA)
    ds = spark.createDataFrame([("gateways/g1/datasources", 0, 200, json.dumps({"value": [
        {"id": "d1", "credentialDetails": {"credentialType": "Basic"}, "details": {}}]}))], PAGE_SCHEMA)
    us = spark.createDataFrame([("gateways/g1/datasources/d1/users", 0, 200,
                                 json.dumps({"value": [{"emailAddress": "e"}]}))], PAGE_SCHEMA)
    schemas = {"gateways": "struct<id:string,name:string>",
               "gateway_datasources": "struct<id:string,credentialDetails:struct<credentialType:string>,"
                                      "details:struct<server:string>>",
               "gateway_datasource_users": "struct<emailAddress:string>"}
    t = TP.build_gateways(gw, ds, us, schemas, "2024-06-01 12:00:00")
    assert t["gateways"].count() == 2
    d = t["gateway_datasources"].first()
    assert (d.gatewayId, d.credentialDetails_credentialType, d.details_server) == ("g1", "Basic", None)
    u = t["gateway_datasource_users"].first()
    assert (u.gatewayId, u.datasourceId, u.emailAddress) == ("g1", "d1", "e")


def test_save_policies(spark):
    from landflow.plans.pipelines import save_dataflow_sources, save_metadata, save_settings

    db = unique_name("lf_save")
    SK.ensure_schema(spark, db, scratch_path(spark, db))
    full = spark.createDataFrame([("a",)], "k string")
    empty = spark.createDataFrame([], "k string")
    assert save_metadata({"t": full, "u": empty}, db) == {"t": 1, "u": None}
    assert not spark.catalog.tableExists(f"{db}.u")
    assert save_settings({"u": empty}, db) == {"u": 0}
    assert spark.catalog.tableExists(f"{db}.u")
    with pytest.raises(SK.EmptyInput):
        save_dataflow_sources(empty, db)
    assert save_dataflow_sources(full, db) == 1


def test_infer_keys_and_schema(spark):
    from landflow.operators.aggregates import infer_item_schema, infer_keys

    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2.5,"c":{"d":true}}',), ('{"b":null}',)], "raw string") \
        .select(F.parse_json("raw").alias("item"))
    keys = {r.key: (r.rows, r.type_name) for r in infer_keys(df).collect()}
    assert keys["a"][0] == 2 and keys["b"][0] == 2 and keys["c"] == (1, "OBJECT<d: BOOLEAN>")
    ddl = infer_item_schema(df)
    assert ddl.startswith("OBJECT<") and "c: OBJECT<d: BOOLEAN>" in ddl


def test_quarantine_lists_wrong_types(spark):
    recs = [{"Id": "1", "RecordType": "x", "IsSuccess": True}, {"Id": "2", "RecordType": 4, "CreationTime": None}]
    pages = spark.createDataFrame([_page("d", 0, recs, True)], PAGE_SCHEMA)
    got = [(r.Id, r.bad_field) for r in TP.activity_quarantine(pages).collect()]
    assert got == [("1", "RecordType")]


def test_dataflow_sources_need_stored_keys(spark):
    db = unique_name("lf_df")
    SK.ensure_schema(spark, db, scratch_path(spark, db))
    SK.write_full_refresh(spark.createDataFrame([], "objectId string"), f"{db}.dataflows", "replace")
    pages = spark.createDataFrame([("dataflows/a/datasources", 0, 200, '{"value":[{"datasourceId":"1"}]}')], PAGE_SCHEMA)
    with pytest.raises(SK.EmptyInput):
        TP.build_dataflow_sources(spark, f"{db}.dataflows", pages, "struct<datasourceId:string>", "2024-06-01 12:00:00")
    SK.write_full_refresh(spark.createDataFrame([("a",), ("b",)], "objectId string"), f"{db}.dataflows", "replace")
    pages = pages.unionByName(spark.createDataFrame([("dataflows/b/datasources", 0, 503, "busy")], PAGE_SCHEMA))
    out, bad = TP.build_dataflow_sources(spark, f"{db}.dataflows", pages, "struct<datasourceId:string>",
                                         "2024-06-01 12:00:00")
    assert [(r.dataflowId, r.datasourceId) for r in out.collect()] == [("a", "1")]
    assert [r.reason for r in bad.collect()] == ["status 503"]
