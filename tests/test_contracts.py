import json

import pytest
from pyspark.sql.types import StructType

from landflow.plans import contract_store as CS
from landflow.plans import jobs as J
from landflow.session import scratch_path, unique_name
from landflow.sinks.tables import ensure_schema
from landflow.sources import pages as PG
from landflow.sources.pages import PAGE_SCHEMA, IncompleteChain, write_pages

D = StructType.fromDDL


def test_merge_keeps_every_key(spark):
    a = D("k bigint, v void, s struct<x:bigint>, l array<void>, t string, b boolean")
    b = D("k double, v bigint, s struct<y:string>, l array<struct<z:bigint>>, t bigint, n variant")
    want = D("k double, v bigint, s struct<x:bigint,y:string>, l array<struct<z:bigint>>, t string, b boolean, n variant")
    assert CS.merged(a, b) == want and CS.merged(want, a) == want and CS.merged(want, b) == want
    assert CS.declared_types(D("v void, l array<void>, s struct<v:void>")) == D("v string, l array<string>, s struct<v:string>")
    assert CS.type_paths(D("a struct<b:array<struct<c:bigint>>>, d string")) == [("a.b[].c", "bigint"), ("d", "string")]
    odd = D("`a b` bigint, `c``d` struct<`e.f`:void>")
    assert CS._struct(CS._ddl(odd)) == odd and CS._ddl(CS._struct("")) == ""


def _pages(spark, bodies):
    return spark.createDataFrame([(f"k{i}", 0, 200, b) for i, b in enumerate(bodies)], PAGE_SCHEMA)


def test_a_run_is_inferred_once(spark, monkeypatch):
    db = unique_name("lf_contracts")
    ensure_schema(spark, db, scratch_path(spark, db))
    first = _pages(spark, ['{"value":[{"a":1,"gone":{"x":null}}]}', '{"value":[{"lost":1}],"@odata.nextLink":"n"}'])
    store = CS.Contracts(spark, db)
    assert store.of("f", first, PG.ODATA, "1") == D("a bigint, gone struct<x:string>")
    store.save()
    second = _pages(spark, ['{"value":[{"a":1.5,"gone":{"x":true}}]}'])
    store = CS.Contracts(spark, db)
    assert store.of("f", second, PG.ODATA, "2") == D("a double, gone struct<x:boolean>")
    store.save()
    read = []
    inferred = CS.infer_item_schema
    monkeypatch.setattr(CS, "infer_item_schema", lambda items: read.append(1) or inferred(items))
    store = CS.Contracts(spark, db)
    assert store.of("f", second, PG.ODATA, "2") == D("a double, gone struct<x:boolean>") and not read
    # more pages of a run: its sketch is taken again, and replaces the old one
    more = second.unionByName(spark.createDataFrame([("z", 0, 200, '{"value":[{"new":"x"}]}')], PAGE_SCHEMA))
    assert store.of("f", more, PG.ODATA, "2").fieldNames() == ["a", "gone", "new"] and read
    store.save()
    assert sorted((r.run_id, r.pages) for r in spark.read.table(f"{db}.{CS.STORE}").collect()) == [("1", 2), ("2", 2)]
    assert store.of("f", second.limit(0), PG.ODATA, "3").fieldNames() == ["a", "gone", "new"]
    assert store.of("f", second, PG.ODATA, "9", "struct<q:int>") == D("q int")
    with pytest.raises(IncompleteChain):
        store.of("other", second.limit(0), PG.ODATA, "3")
    with pytest.raises(IncompleteChain):
        store.of("other", first.where("request_key = 'k1'"), PG.ODATA, "3")
    with pytest.raises(ValueError):
        store.of("other", _pages(spark, ['{"value":[]}']), PG.ODATA, "3")


def test_landings_without_runs_share_a_sketch(spark):
    db = unique_name("lf_contracts")
    ensure_schema(spark, db, scratch_path(spark, db))
    for body in ('{"tenantSettings":[{"settingName":"S","a":1}]}', '{"tenantSettings":[{"settingName":"S","b":1}]}'):
        store = CS.Contracts(spark, db)
        store.of("f", _pages(spark, [body]), PG.SETTINGS, None)
        store.save()
    rows = spark.read.table(f"{db}.{CS.STORE}").collect()
    assert len(rows) == 1 and CS._struct(rows[0].ddl).fieldNames() == ["a", "settingName", "b"]


def test_a_key_that_a_run_lacks_keeps_its_column(spark):
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    for items in ([{"settingName": "S", "enabled": True, "note": "n", "properties": [{"name": "p"}]}], [{"settingName": "S", "enabled": True}]):
        root = scratch_path(spark, "jobs-contract")
        write_pages(spark.createDataFrame([("tenantsettings", 0, 200, json.dumps({"tenantSettings": items}))], PAGE_SCHEMA), f"{root}/tenant_settings")
        J.settings_job(spark, root, db, run_ts="2024-06-01 12:00:00")
    assert spark.read.table(f"{db}.tenant_settings").first().note is None
    assert spark.read.table(f"{db}.properties").count() == 0
