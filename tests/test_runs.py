import json

import pytest
from pyspark.sql import functions as F

from landflow import session
from landflow.plans import jobs as J
from landflow.plans import pipelines as TP
from landflow.session import scratch_path, unique_name
from landflow.sinks import tables as SK
from landflow.sources import pages as PG
from landflow.sources import runs as RN

RUN = "request_key string, page_no long, status int, raw string, run_id string"
CAP = "struct<id:string>"


def _value(*ids, link=None):
    return json.dumps({"value": [{"id": i} for i in ids]} | ({"@odata.nextLink": link} if link else {}))


def _db(spark):
    db = unique_name("lf_runs")
    SK.ensure_schema(spark, db, scratch_path(spark, db))
    return db


def test_runs_are_ordered_by_time_or_number(spark):
    def last(*ids):
        return RN.latest_run(spark.createDataFrame([("k", 0, 200, "{}", i) for i in ids], RUN))

    assert last("9", "10", "2") == "10"
    assert last("2024-06-01 09:00:00", "2024-06-01T10:00:00") == "2024-06-01T10:00:00"
    assert last("a", "b", None) == "b"
    assert last(None) is None
    assert RN.latest_run(spark.createDataFrame([], RUN), spark.createDataFrame([], PG.PAGE_SCHEMA)) is None


def test_one_run_for_all_families(spark):
    """A vanished request goes, and a family that the run never reached stops the job."""
    caps = spark.createDataFrame([("capacities", 0, 200, _value("c1"), "1"), ("capacities", 0, 200, _value("c2"), "2")], RUN)
    other = spark.createDataFrame([("apps", 0, 200, _value("a1"), "1")], RUN)
    assert [r.id for r in TP.build_capacities(caps, CAP, "2024-06-01 12:00:00").collect()] == ["c2"]
    assert [r.id for r in TP.build_capacities(caps, CAP, "2024-06-01 12:00:00", run="1").collect()] == ["c1"]
    got = RN.snapshot({"caps": caps, "apps": other})
    assert [r.raw for r in got["caps"].collect()] == [_value("c2")] and got["apps"].isEmpty()
    with pytest.raises(RN.MissingRun):
        RN.snapshot({"caps": caps, "apps": other}, needed=("caps", "apps"))


def test_a_failed_latest_run_is_not_replaced_by_an_older_one(spark):
    caps = spark.createDataFrame([("capacities", 0, 200, _value("c1"), "1"), ("capacities", 0, 503, "busy", "2")], RUN)
    with pytest.raises(PG.IncompleteChain):
        TP.build_capacities(caps, CAP, "2024-06-01 12:00:00")


GW = {"gateways": "struct<id:string>", "gateway_datasources": "struct<id:string>", "gateway_datasource_users": "struct<id:string>"}


def _gateways(spark, rows):
    df = spark.createDataFrame([(k, 0, 200, b) for k, b in rows], PG.PAGE_SCHEMA)
    return [df.where(F.col("request_key").rlike(p)) for p in (r"^gateways$", r"^gateways/[^/]+/datasources$", r"/users$")]


def test_every_parent_must_have_landed(spark):
    rows = [("gateways", _value("g1", "g2", "")), ("gateways/g1/datasources", _value("d1")),
            ("gateways/g1/datasources/d1/users", _value("u1")), ("gateways/gone/datasources", "not json")]
    with pytest.raises(PG.IncompleteChain, match="gateways/g2/datasources"):
        TP.build_gateways(*_gateways(spark, rows), GW, "2024-06-01 12:00:00")
    rows.append(("gateways/g2/datasources", _value()))  # answered, without datasources
    t = TP.build_gateways(*_gateways(spark, rows), GW, "2024-06-01 12:00:00")
    assert [(r.gatewayId, r.datasourceId, r.id) for r in t["gateway_datasource_users"].collect()] == [("g1", "d1", "u1")]
    with pytest.raises(PG.IncompleteChain, match="d1/users"):
        TP.build_gateways(*_gateways(spark, [r for r in rows if not r[0].endswith("users")]), GW, "2024-06-01 12:00:00")


def test_missing_requests_say_why(spark):
    pages = spark.createDataFrame([("a", 0, 200, _value("1")), ("b", 0, 500, "x"), ("c", 0, 200, _value("1", link="n")), ("z", 0, 500, "x")], PG.PAGE_SCHEMA)
    keys = spark.createDataFrame([(k,) for k in ("a", "b", "c", "d")], "k string")
    got = RN.missing_requests(RN.request_keys(keys, F.col("k")), pages, PG.ODATA)
    assert {tuple(r) for r in got.collect()} == {("b", "failed"), ("c", "incomplete chain"), ("d", "not landed")}
    none = RN.missing_requests(RN.request_keys(keys.where("false"), F.col("k")), pages, PG.ODATA)
    assert none.isEmpty()


def test_dataflows_that_never_landed_are_quarantined(spark):
    db = _db(spark)
    SK.write_full_refresh(spark.createDataFrame([("a",), ("b",), ("c",), ("",)], "objectId string"), f"{db}.dataflows", "replace")
    rows = [("dataflows/a/datasources", 0, 200, _value("s1"), "1"), ("dataflows/b/datasources", 0, 200, _value("s2"), "1"),
            ("dataflows/a/datasources", 0, 200, _value("s3"), "2"), ("dataflows/b/datasources", 0, 503, "busy", "2"),
            ("dataflows/gone/datasources", 0, 503, "busy", "2")]
    out, bad = TP.build_dataflow_sources(spark, f"{db}.dataflows", spark.createDataFrame(rows, RUN), "struct<id:string>", "2024-06-01 12:00:00")
    assert [(r.dataflowId, r.id) for r in out.collect()] == [("a", "s3")]
    assert {(r.request_key, r.reason) for r in bad.collect()} == {("dataflows/b/datasources", "status 503"), ("dataflows/c/datasources", "not landed")}


def _events(key, no, ids, last, run=None):
    body = {"activityEventEntities": [{"Id": i} for i in ids], "lastResultSet": last} | ({} if last else {"continuationUri": "/n"})
    return (key, no, 200, json.dumps(body), run)


def test_a_day_is_loaded_whole_or_not_at_all(spark):
    rows = [_events("x/2024-01-15/a", 0, ["1"], True), _events("x/2024-01-15/b", 0, ["2"], False), _events("x/2024-01-16/a", 0, ["3"], True)]
    pages = spark.createDataFrame([r[:4] for r in rows], PG.PAGE_SCHEMA)
    assert [r.Id for r in TP.activity_rows(pages, "2024-06-01 12:00:00").collect()] == ["3"]
    assert [tuple(r) for r in TP.activity_days_quarantine(pages).collect()] == [("2024-01-15", "x/2024-01-15/b", "incomplete chain")]
    t = f"{_db(spark)}.events"
    with pytest.raises(TP.IncompleteDay):
        TP.load_activity_day(pages, t, "2024-06-01 12:00:00", "2024-01-15")
    assert not spark.catalog.tableExists(t)


def test_a_day_comes_from_its_latest_run(spark):
    rows = [_events("x/2024-01-15", 0, ["old", "gone"], True, "9"), _events("x/2024-01-15", 0, ["new"], True, "10"),
            _events("x/2024-01-16", 0, ["only"], True, "9"), _events("x/2024-01-17", 0, ["a"], True, "9"),
            _events("x/2024-01-17", 0, ["b"], False, "10"), _events("x/2024-01-18", 0, ["unnamed"], True, None)]
    pages = spark.createDataFrame(rows, RUN)
    got = {(r.Id, r.LoadDate) for r in TP.activity_rows(pages, "2024-06-01 12:00:00").collect()}
    assert got == {("new", "2024-01-15"), ("only", "2024-01-16"), ("unnamed", "2024-01-18")}


def test_manifest(spark):
    pages = spark.createDataFrame([("a", 0, 200, _value("1"), "1"), ("b", 0, 500, "x", "1"), ("a", 0, 200, _value("1", link="n"), "2")], RUN)
    got = {tuple(r) for r in RN.run_manifest({"f": pages}, {"f": PG.ODATA}).collect()}
    assert got == {("f", "1", 2, 1, 1, 0, False), ("f", "2", 1, 0, 0, 1, True)}


def test_partition_columns_evolve_by_name(spark):
    t = f"{_db(spark)}.t"
    SK.replace_partition(spark.createDataFrame([(1, 1.5, "a"), (2, 2.5, "b")], "k long, v double, day string"), t, "day")
    new = spark.createDataFrame([("b", 3, 7, "x", True)], "day string, V int, K int, extra string, `odd ``name` boolean")
    assert SK.replace_partition(new, t, "day") == 1
    rows = {r.day: r.asDict() for r in spark.read.table(t).collect()}
    assert rows["a"] == {"k": 1, "v": 1.5, "extra": None, "odd `name": None, "day": "a"}
    assert rows["b"] == {"k": 7, "v": 3.0, "extra": "x", "odd `name": True, "day": "b"}
    SK.replace_partition(spark.createDataFrame([("b", 9)], "day string, k long"), t, "day")  # absent columns are null
    assert {r.day: (r.k, r.v, r.extra) for r in spark.read.table(t).collect()} == {"a": (1, 1.5, None), "b": (9, None, None)}
    with pytest.raises(ValueError, match="column k"):
        SK.replace_partition(spark.createDataFrame([("b", "text")], "day string, k string"), t, "day")
    with pytest.raises(ValueError, match="case"):
        SK.replace_partition(spark.createDataFrame([("b", 1, 2)], "day string, n long, N long"), t, "day")
    assert spark.read.table(t).count() == 2 and spark.read.table(t).columns == ["k", "v", "extra", "odd `name", "day"]


def test_malformed_lines_stop_or_are_kept(spark):
    root = scratch_path(spark, "malformed")
    lines = ['{"request_key":"capacities","page_no":0,"status":200,"raw":%s}' % json.dumps(_value("c1")), '{"request_key":"capac', '{"page_no":1,"status":200,"raw":"{}"}',
             '{"request_key":"k","page_no":"one","status":200,"raw":"{}"}', '{"request_key":"k","page_no":2}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/capacities")
    with pytest.raises(Exception, match="malformed page line"):
        PG.read_pages(spark, f"{root}/capacities").count()
    kept = PG.read_pages(spark, f"{root}/capacities", malformed="skip")
    assert kept.columns == ["request_key", "page_no", "status", "raw"] and kept.count() == 1
    bad = {(r.text, r.reason) for r in PG.malformed_lines(spark, f"{root}/capacities").collect()}
    assert bad == {(lines[1], "malformed line"), (lines[2], "no key"), (lines[3], "malformed line"), (lines[4], "no answer")}
    db = _db(spark)
    with pytest.raises(Exception, match="malformed page line"):
        J.metadata_job(spark, root, db, {"capacities": CAP})
    assert J.metadata_job(spark, root, db, {"capacities": CAP}, malformed="skip") == {"capacities": 1}
    assert {(r.family, r.reason) for r in spark.read.table(f"{db}.landing_quarantine").collect()} == {
        ("capacities", "malformed line"), ("capacities", "no key"), ("capacities", "no answer")}


def test_jobs_read_one_run_of_a_landing(spark):
    root, db = scratch_path(spark, "job-runs"), _db(spark)
    for run, caps in (("9", ["c1", "c2"]), ("10", ["c2"])):
        rows = [("capacities", 0, 200, _value(*caps))]
        PG.write_pages(spark.createDataFrame(rows, PG.PAGE_SCHEMA), f"{root}/capacities/run_id={run}")
    assert J.metadata_job(spark, root, db, {"capacities": CAP}) == {"capacities": 1}
    assert J.metadata_job(spark, root, db, {"capacities": CAP}, run="9") == {"capacities": 2}


def test_runs_of_a_request_are_compared_where_its_chains_are(spark, monkeypatch):
    """Many relanded requests: the latest complete run counts, in tasks by rows, with
    no shuffle between the chains and the choice of a run."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = [(f"k{k}", 0, 500 if run == "2" and k % 3 == 0 else 200, _value(f"{k}-{run}"), run) for k in range(1000) for run in "12"]
    pages = spark.createDataFrame(rows, RUN)
    status = PG.chain_status(pages, PG.ODATA)
    best = status.where("complete").groupBy("request_key").agg(F.max("run_id").alias("run"))
    assert best.rdd.getNumPartitions() >= 40
    got = {r[0] for r in PG.items_as(PG.usable_items(pages, PG.ODATA), CAP).select("id").collect()}
    assert got == {f"{k}-{1 if k % 3 == 0 else 2}" for k in range(1000)}


def test_bodies_of_many_chains_are_joined_in_tasks_by_rows(spark, monkeypatch):
    """Chains too many to broadcast: their pages are dealt by rows, not by the shuffle's bytes."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    monkeypatch.setattr(PG, "bounded_broadcast", lambda df: df)
    rows = [(f"k{k}", 0, 500 if run == "2" and k % 3 == 0 else 200, _value(f"{k}-{run}"), run) for k in range(1000) for run in "12"]
    pages = spark.createDataFrame(rows, RUN)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = PG.usable_items(pages, PG.ODATA)
        assert items.rdd.getNumPartitions() >= 20
        got = sorted(r[0] for r in PG.items_as(items, CAP).select("id").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(f"{k}-{1 if k % 3 == 0 else 2}" for k in range(1000))
