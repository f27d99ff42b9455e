import json

import pytest

from landflow.plans import jobs as J
from landflow.plans.table_queries import SETTING
from landflow.session import scratch_path, unique_name
from landflow.sinks.tables import EmptyInput, ensure_schema
from landflow.sources.pages import PAGE_SCHEMA, IncompleteChain, write_pages


def _land(spark, root, family, rows):
    df = spark.createDataFrame([(k, n, 200, json.dumps(body)) for k, n, body in rows], PAGE_SCHEMA)
    write_pages(df, f"{root}/{J.LANDING[family]}")


def test_metadata_job_infers_contracts(spark):
    root = scratch_path(spark, "jobs-landing")
    _land(spark, root, "capacities", [("capacities", 0, {"value": [
        {"id": "c1", "displayName": "one", "admins": ["a", "b"], "users": [{"u": 1}]},
        {"id": "c2", "displayName": "two", "admins": None}]})])
    _land(spark, root, "gateways", [("gateways", 0, {"value": [{"id": "g1", "name": "G", "publicKey": {"e": 1}}]})])
    _land(spark, root, "gateway_datasources", [("gateways/g1/datasources", 0, {"value": [
        {"id": "d1", "credentialDetails": {"credentialType": "Basic"}, "details": {"server": "s"}}]})])
    _land(spark, root, "gateway_datasource_users", [("gateways/g1/datasources/d1/users", 0, {"value": [
        {"emailAddress": "e@x", "users": ["x"]}]})])
    _land(spark, root, "workspaces", [("groups", 0, {"value": [
        {"id": "w1", "name": "W", "type": "Workspace", "state": "Active", "isOnDedicatedCapacity": True,
         "users": [{"identifier": "i", "profile": {"id": "p"}}], "reports": [{"id": "r1", "name": "R"}],
         "datasets": [{"id": "s1", "qnaQuestions": ["q"]}], "dataflows": [{"objectId": "f1"}]},
        {"id": "w2", "name": "gone", "type": "Workspace", "state": "Deleted", "reports": [{"id": "r2"}]}]})])
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    out = J.metadata_job(spark, root, db, run_ts="2024-06-01 12:00:00")
    assert out == {"capacities": 2, "gateways": 1, "gateway_datasources": 1, "gateway_datasource_users": 1,
                   "workspaces": 1, "workspaces_users": 1, "reports": 1, "datasets": 1, "dataflows": 1}
    caps = {r.id: r.admins for r in spark.read.table(f"{db}.capacities").collect()}
    assert caps == {"c1": "a, b", "c2": None}
    assert "users" not in spark.read.table(f"{db}.capacities").columns
    u = spark.read.table(f"{db}.gateway_datasource_users").first()
    assert (u.gatewayId, u.datasourceId, u.emailAddress) == ("g1", "d1", "e@x")
    assert spark.read.table(f"{db}.datasets").first().qnaQuestions == '["q"]'


def test_activity_job_defaults_to_yesterday(spark):
    root = scratch_path(spark, "jobs-activity")
    _land(spark, root, "activity_events", [("activityevents/2024-02-29", 0, {
        "activityEventEntities": [{"Id": "a", "CreationTime": "2024-02-29T10:00:00", "Activity": "ViewReport"}],
        "lastResultSet": True})])
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    assert J.choose_day(spark, "not a day", "2024-03-01 00:30:00") == "2024-02-29"
    assert J.activity_job(spark, root, f"{db}.activity_events", None, now="2024-03-01 00:30:00") == 1
    r = spark.read.table(f"{db}.activity_events").first()
    assert (r.Id, r.Activity, r.LoadDate) == ("a", "ViewReport", "2024-02-29")


def test_settings_and_dataflow_jobs_via_cli(spark, capsys):
    root = scratch_path(spark, "jobs-settings")
    _land(spark, root, "tenant_settings", [("tenantsettings", 0, {"tenantSettings": [
        {"settingName": "S1", "enabled": True, "enabledSecurityGroups": [{"graphId": "g", "name": "G"}],
         "properties": None},
        {"settingName": "S2", "enabled": False}]})])
    _land(spark, root, "dataflow_datasources", [
        ("dataflows/f1/datasources", 0, {"value": [{"datasourceId": "d1", "connectionDetails": {"server": "s"}}]}),
        ("dataflows/f9/datasources", 0, {"value": [{"datasourceId": "d9"}]})])
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    J.main(["settings", "--landing", root, "--schema", db])
    assert "'tenant_settings': 2" in capsys.readouterr().out
    assert spark.read.table(f"{db}.enabled_security_groups").count() == 1
    assert spark.read.table(f"{db}.properties").count() == 0  # empty child table written empty
    spark.createDataFrame([("f1",)], "objectId string").write.saveAsTable(f"{db}.dataflows")
    assert J.dataflow_sources_job(spark, root, db, run_ts="2024-06-01 12:00:00") == 1
    r = spark.read.table(f"{db}.dataflow_sources").first()
    assert (r.dataflowId, r.datasourceId, r.connectionDetails_server) == ("f1", "d1", "s")


def test_failed_or_empty_runs_leave_stored_tables(spark):
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    first, second, third = (scratch_path(spark, "jobs-failed") for _ in range(3))
    body = {"tenantSettings": [{"settingName": "S1", "enabled": True, "properties": [{"name": "n"}]}]}
    _land(spark, first, "tenant_settings", [("tenantsettings", 0, body)])
    J.settings_job(spark, first, db, SETTING)
    rows = [("tenantsettings", 0, 503, "busy")]
    write_pages(spark.createDataFrame(rows, PAGE_SCHEMA), f"{second}/tenant_settings")
    with pytest.raises(IncompleteChain):
        J.settings_job(spark, second, db, SETTING)
    _land(spark, third, "tenant_settings", [("tenantsettings", 0, {"tenantSettings": []})])
    with pytest.raises(EmptyInput):
        J.settings_job(spark, third, db, SETTING)
    assert spark.read.table(f"{db}.tenant_settings").count() == spark.read.table(f"{db}.properties").count() == 1


def test_a_second_night_may_add_keys_and_longer_numbers(spark):
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    for items in ([{"id": "c1", "size": 1.5, "AVOIDED": "x", "note": None}],
                  [{"id": "c1", "size": 12.75, "AVOIDED": "y", "new": 3, "tags": ["a"]}, {"id": "c2", "size": 2}]):
        root = scratch_path(spark, "jobs-night")
        _land(spark, root, "capacities", [("capacities", 0, {"value": items})])
        J.metadata_job(spark, root, db, run_ts="2024-06-01 12:00:00")
    rows = {r.id: r for r in spark.read.table(f"{db}.capacities").collect()}
    assert (rows["c1"].size, rows["c1"].AVOIDED, rows["c1"].new, rows["c1"].tags, rows["c1"].note) == (12.75, "y", 3, '["a"]', None)
    assert rows["c2"].size == 2.0


def test_dataflow_job_stores_its_quarantine(spark):
    db = unique_name("lf_jobs")
    ensure_schema(spark, db, scratch_path(spark, db))
    root = scratch_path(spark, "jobs-quarantine")
    rows = [("dataflows/f1/datasources", 0, 200, '{"value":[{"datasourceId":"d1"}]}'),
            ("dataflows/f2/datasources", 0, 503, "busy"),
            ("dataflows/f3/datasources", 0, 200, '{"value":[{"datasourceId":"d3"}],"@odata.nextLink":"n"}')]
    write_pages(spark.createDataFrame(rows, PAGE_SCHEMA), f"{root}/dataflow_datasources")
    spark.createDataFrame([("f1",), ("f2",), ("f3",)], "objectId string").write.saveAsTable(f"{db}.dataflows")
    assert J.dataflow_sources_job(spark, root, db, "struct<datasourceId:string>") == 1
    kept = {r.request_key: r.reason for r in spark.read.table(f"{db}.dataflow_sources_quarantine").collect()}
    assert kept == {"dataflows/f2/datasources": "status 503", "dataflows/f3/datasources": "incomplete chain"}
