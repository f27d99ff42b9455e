import pytest
from pyspark.sql import functions as F
from pyspark.sql import Row

from landflow import session
from landflow.session import scratch_path
from landflow.sources import pages as PG


def _pages(spark, rows):
    return spark.createDataFrame(rows, PG.PAGE_SCHEMA)


def test_unnest_list_object_absent(spark):
    pages = _pages(spark, [
        ("a", 0, 200, '{"value":[{"id":"1"},{"id":"2"}],"@odata.nextLink":"x"}'),
        ("a", 1, 200, '{"value":{"id":"3"}}'),
        ("b", 0, 200, '{"other":1}'),
        ("c", 0, 200, '{"value":[]}'),
        ("d", 0, 200, '{"value":null}'),
    ])
    items = PG.items_as(PG.unnest_pages(pages, PG.ODATA), "struct<id:string>")
    got = sorted((r.request_key, r.page_no, r.id) for r in items.collect())
    assert got == [("a", 0, "1"), ("a", 0, "2"), ("a", 1, "3")]


def test_envelope_terminal_rules(spark):
    pages = _pages(spark, [
        ("a", 0, 200, '{"activityEventEntities":[{"Id":"1"}],"continuationUri":"u","lastResultSet":false}'),
        ("a", 1, 200, '{"activityEventEntities":[],"continuationUri":"u","lastResultSet":true}'),
        ("b", 0, 200, '{"activityEventEntities":[{"Id":"2"}]}'),
    ])
    env = {(r.request_key, r.page_no): r for r in PG.page_envelope(pages, PG.ACTIVITY).collect()}
    assert env[("a", 0)].terminal is False and env[("a", 0)].n_items == 1
    assert env[("a", 1)].terminal is True and env[("a", 1)].n_items == 0
    assert env[("b", 0)].terminal is True  # no continuation link


def test_keep_until_terminal_drops_later_pages(spark):
    pages = _pages(spark, [
        ("a", 0, 200, '{"value":[{"id":"1"}],"@odata.nextLink":"n"}'),
        ("a", 1, 200, '{"value":[{"id":"2"}]}'),
        ("a", 2, 200, '{"value":[{"id":"late"}],"@odata.nextLink":"n"}'),
        ("b", 0, 200, '{"value":[{"id":"3"}],"@odata.nextLink":"n"}'),
    ])
    items = PG.unnest_pages(pages, PG.ODATA, with_terminal=True)
    kept = PG.items_as(PG.keep_until_terminal(items).where(F.col("item").isNotNull()), "struct<id:string>")
    assert sorted(r.id for r in kept.collect()) == ["1", "2", "3"]
    usable = PG.items_as(PG.usable_items(pages, PG.ODATA), "struct<id:string>")
    assert sorted(r.id for r in usable.collect()) == ["1", "2"]  # the open chain is not complete


def test_incomplete_chains_are_skipped_or_end_the_job(spark):
    more, end = '{"value":[{"id":"%s"}],"@odata.nextLink":"n"}', '{"value":[{"id":"%s"}]}'
    pages = _pages(spark, [
        ("whole", 0, 200, more % 1), ("whole", 1, 200, end % 2), ("whole", 3, 200, end % "late"),
        ("gap", 0, 200, more % "g"), ("gap", 2, 200, end % "g"),
        ("late start", 1, 200, end % "s"),
        ("twice", 0, 200, end % "t"), ("twice", 0, 200, end % "t"),
        ("open", 0, 200, more % "o"),
        ("no status", 0, None, end % "n"),
    ])
    got = {r.request_key: r.complete for r in PG.chain_status(pages, PG.ODATA).collect()}
    assert got == {"whole": True, "gap": False, "late start": False, "twice": False, "open": False, "no status": False}
    items = PG.items_as(PG.usable_items(pages, PG.ODATA), "struct<id:string>")
    assert sorted(r.id for r in items.collect()) == ["1", "2"]
    with pytest.raises(PG.IncompleteChain):
        PG.usable_items(pages, PG.ODATA, on_incomplete="stop")
    lost = {r.request_key for r in PG.incomplete_chains(pages, PG.ODATA).collect()}
    assert lost == {"gap", "late start", "twice", "open"}


def test_latest_complete_run_counts(spark):
    more, end = '{"value":[{"id":"%s"}],"@odata.nextLink":"n"}', '{"value":[{"id":"%s"}]}'
    schema = PG.PAGE_SCHEMA.simpleString()[7:-1] + ",run_id:string"
    pages = spark.createDataFrame([
        ("k", 0, 200, more % "a", "1"), ("k", 1, 200, end % "b", "1"),
        ("k", 0, 200, more % "a", "2"), ("k", 1, 200, more % "b", "2"), ("k", 2, 200, end % "c", "2"),
        ("k", 0, 200, more % "x", "3"), ("k", 1, 503, "busy", "3")], f"struct<{schema}>")
    items = PG.items_as(PG.usable_items(pages, PG.ODATA, on_incomplete="stop"), "struct<id:string>")
    assert sorted(r.id for r in items.collect()) == ["a", "b", "c"]


def test_a_body_unfit_for_variant_is_split_into_items(spark):
    pages = _pages(spark, [("a", 0, 200, '{"value":[{"id":"1"},{"id":"2","id":"3"},null,4,"x"],"@odata.nextLink":"n"}'),  # a repeated key
                           ("b", 0, 200, '{"value":{"id":"5"},"value2":{"k":1,"k":2}}'), ("c", 0, 200, '{"value":[{"id":"6"}]}')])
    with pytest.raises(Exception, match="VARIANT"):
        PG.unnest_pages(pages, PG.ODATA).collect()
    with pytest.raises(ValueError):
        PG.unnest_pages(pages, PG.ODATA, unfit="drop")
    items = PG.unnest_pages(pages, PG.ODATA, with_terminal=True, unfit="skip")
    got = items.select("request_key", "terminal", F.to_json("item").alias("j")).collect()
    assert sorted(tuple(r) for r in got) == [("a", False, '"x"'), ("a", False, "4"), ("a", False, "null"), ("a", False, '{"id":"1"}'),
                                             ("b", True, '{"id":"5"}'), ("c", True, '{"id":"6"}')]
    lost = PG.unfit_items(pages, PG.ODATA).collect()
    assert [(r.request_key, r.position, r.item_text) for r in lost] == [("a", 1, '{"id":"2","id":"3"}')]


def test_landed_counts_need_no_body(spark):
    rows = [("a", 0, 200, '{"value":[{"i":[1,2]},null,"x"],"@odata.nextLink":"n"}'), ("a", 1, 200, '{"value":{"i":1}}'),
            ("b", 0, 200, '{"value":[]}'), ("c", 0, 200, '{"value":"[1,2]"}'), ("d", 0, 500, "busy"), ("e", 0, 200, None), ("f", 0, 200, '{"value":null}')]
    pages = _pages(spark, rows)
    path = scratch_path(spark, "counted")
    PG.write_pages(pages, path, fmt="parquet", dialect=PG.ODATA, count_items=True)
    landed = PG.page_audit(PG.read_pages(spark, path, fmt="parquet"), PG.ODATA)
    want = [("a", 0, 3, 3), ("a", 1, 1, 4), *[(k, 0, 0, 0) for k in "bcdef"]]
    for audit in (landed, PG.page_audit(pages, PG.ODATA)):
        assert sorted((r.request_key, r.page_no, r.n_items, r.items_so_far) for r in audit.collect()) == want
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "raw" not in plan and "json" not in plan
    with pytest.raises(ValueError):
        PG.write_pages(pages, path, count_items=True)


def test_failed_chain_is_left_out_and_quarantined(spark):
    pages = _pages(spark, [
        ("a", 0, 200, '{"value":[{"id":"1"}],"@odata.nextLink":"n"}'),
        ("a", 1, 500, 'error'),
        ("b", 0, 200, '{"value":[{"id":"2"}]}'),
        ("c", 0, 200, '{"value":[{"id":"3"}'),
    ])
    usable = PG.items_as(PG.usable_items(pages, PG.ODATA), "struct<id:string>")
    assert [r.id for r in usable.collect()] == ["2"]
    good, bad = PG.split_failed(pages)
    assert good.count() == 2
    assert sorted(r.reason for r in bad.collect()) == ["status 500", "unparseable body"]


def test_page_audit_matches_brute_force(spark):
    rows = []
    for key, n_pages in (("a", 9000), ("b", 3)):  # "a" spans several blocks
        for p in range(n_pages):
            n = (p * 7) % 5
            rows.append((key, p, 200, '{"value":[' + ",".join(['{"i":1}'] * n) + "]}"))
    got = {(r.request_key, r.page_no): (r.n_items, r.items_so_far)
           for r in PG.page_audit(_pages(spark, rows), PG.ODATA).collect()}
    total = {}
    for key, p, _, raw in rows:
        n = raw.count('"i"')
        total[key] = total.get(key, 0) + n
        assert got[(key, p)] == (n, total[key])


def test_pack_then_unnest_round_trip(spark):
    df = spark.range(0, 1234).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    pages = PG.pack_pages(df, F.concat(F.lit("g/"), F.col("g").cast("string")), F.floor(F.col("k") / 100),
                          F.struct("k"), PG.ODATA, object_when_single=True)
    assert pages.groupBy("page_no", "request_key").count().where("count > 1").count() == 0
    back = PG.items_as(PG.unnest_pages(pages, PG.ODATA), "struct<k:bigint>")
    assert sorted(r.k for r in back.collect()) == list(range(1234))


def test_union_pages_by_name(spark):
    a = spark.createDataFrame([Row(x=1, y="a")])
    b = spark.createDataFrame([Row(y="b", z=2.0)])
    got = sorted(PG.union_pages(a, b).collect(), key=lambda r: r.y)
    assert got[0].asDict() == {"x": 1, "y": "a", "z": None}
    assert got[1].asDict() == {"x": None, "y": "b", "z": 2.0}


def test_scan_keys_reads_one_column(spark, tmp_path):
    spark.range(10).selectExpr("id as objectId", "id * 2 as other").write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("lf_scan_test")
    df = PG.scan_keys(spark, "lf_scan_test", "objectId")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "other" not in plan.split("ReadSchema")[-1]
    assert df.count() == 10


def test_page_bodies_join_by_broadcast(spark):
    body = '{"value":[{"id":"%d"}],"@odata.nextLink":"n"}'
    end = '{"value":[{"id":"%d"}]}'
    pages = _pages(spark, [(f"k{i % 5}", i // 5, 200, (end if i >= 45 else body) % i) for i in range(50)])
    items = PG.usable_items(pages, PG.ODATA)
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("Generate") < plan.index("BroadcastHashJoin")  # pages are cut before they are unnested
    assert items.count() == 50


def test_items_as_parent_key_wins(spark):
    pages = _pages(spark, [("dataflows/d1/datasources", 0, 200, '{"value":[{"id":"x","dataflowId":"other"}]}')])
    items = PG.unnest_pages(pages.withColumn("dataflowId", F.lit("d1")), PG.ODATA, keep=("dataflowId",))
    out = PG.items_as(items, "struct<id:string,dataflowId:string>")
    assert out.columns == ["request_key", "page_no", "dataflowId", "id"]
    assert out.first().dataflowId == "d1"


def test_unnest_texts_keeps_order_and_lone_objects(spark):
    pages = _pages(spark, [
        ("a", 0, 200, '{"activityEventEntities":[{"z":1,"a":2},{"b":"é"}],"lastResultSet":true}'),
        ("b", 0, 200, '{"activityEventEntities":{"k":1}}'),
        ("c", 0, 200, '{"other":[]}'),
    ])
    got = sorted((r.request_key, r.item_text) for r in PG.unnest_texts(pages, PG.ACTIVITY).collect())
    assert got == [("a", '{"b":"é"}'), ("a", '{"z":1,"a":2}'), ("b", '{"k":1}')]


def test_landed_envelope_facts_spare_the_bodies(spark, tmp_path):
    pages = _pages(spark, [("a", 0, 200, '{"value":[{"id":"1"}],"@odata.nextLink":"n"}'),
                           ("a", 1, 200, '{"value":[{"id":"2"}]}'),
                           ("a", 2, 200, '{"value":[{"id":"late"}]}'),
                           ("b", 0, 500, "down")])
    path = str(tmp_path / "landed")
    PG.write_pages(pages, path, fmt="parquet", dialect=PG.ODATA)
    landed = PG.read_pages(spark, path, fmt="parquet")
    assert set(PG.ENVELOPE_COLUMNS) <= set(landed.columns)
    status = PG.chain_status(landed, PG.ODATA)
    scan = [ln for ln in status._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in ln]
    assert scan and all("raw" not in ln.split("ReadSchema")[1] for ln in scan)
    got = PG.items_as(PG.usable_items(landed, PG.ODATA), "struct<id:string>")
    assert sorted(r.id for r in got.collect()) == ["1", "2"]


def test_chain_status_deals_many_pages_over_more_tasks(spark, monkeypatch):
    """Tasks follow the rows; a chain of several blocks, a gap and a double at a block's edge."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    edge = PG.CHAIN_BLOCK

    def chain(key, nos, last):
        return [(key, n, 200, '{"value":[]%s}' % ("" if n == last else ',"@odata.nextLink":"x"')) for n in nos]

    rows = [*chain("whole", range(edge + 50), edge + 49), *chain("gap", [n for n in range(edge + 50) if n != edge], edge + 49),
            *chain("gap before", [n for n in range(edge + 50) if n != edge - 1], edge + 49),
            *chain("twice", [*range(edge + 5), edge], edge + 4), *chain("after the end", [*range(edge + 5), edge + 9], edge + 4),
            *[r for k in range(300) for r in chain(f"k{k}", range(2), 1)]]
    status = PG.chain_status(spark.createDataFrame(rows, PG.PAGE_SCHEMA), PG.ODATA)
    got = {r.request_key: (r.cut, r.complete) for r in status.collect()}
    assert got == {"whole": (edge + 49, True), "gap": (edge + 49, False), "gap before": (edge + 49, False),
                   "twice": (edge + 4, False), "after the end": (edge + 4, True), **{f"k{k}": (1, True) for k in range(300)}}
    assert status.rdd.getNumPartitions() >= 2 * len(rows) // 100


def test_short_chains_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    items = spark.range(3000).select((F.col("id") / 5).cast("long").alias("k"), "id")
    pages = PG.pack_pages(items, F.concat(F.lit("k/"), F.col("k")), F.col("id") % 5 * 2, F.struct("id"), PG.ODATA, renumber=True)
    assert pages.rdd.getNumPartitions() >= 30
    status = PG.chain_status(pages, PG.ODATA)
    assert {(r.cut, r.complete) for r in status.collect()} == {(4, True)} and status.count() == 600
