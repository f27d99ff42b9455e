"""Registered queries for runs, fan-out coverage, whole days and malformed lines."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landflow.plans import contract_store as CS
from landflow.plans import fixtures as FX
from landflow.plans import pipelines as TP
from landflow.plans.fixtures import DAY, RUN_TS, s, table
from landflow.plans.queries import _scratch_schema, query
from landflow.plans.table_queries import DATAFLOW_SOURCE, GATEWAY_SCHEMAS, SETTING, _gateway_pages, _setting_pages
from landflow.session import scratch_path
from landflow.sinks import tables as SK
from landflow.sources import pages as PG
from landflow.sources import runs as RN

TS_SQL = f"TIMESTAMP '{RUN_TS}'"


def _order_requests(spark, sf_dir):
    return RN.request_keys(table(spark, sf_dir, "orders"), F.concat(F.lit("orders/"), s("o_orderkey"), F.lit("/lines")))


def _withheld_lines(spark, sf_dir):
    """Line pages with withheld requests (17), failed ones (13, 11) and chains
    without their first page (7)."""
    key = F.regexp_extract("request_key", r"^orders/(\d+)/", 1).cast("bigint")
    return FX.line_pages(spark, sf_dir, failing=True).where((key % 17 != 0) & ((key % 7 != 0) | (F.col("page_no") > 0)))


@query("q_fan_out_coverage", """
with n as (select o_orderkey as k, (select count(distinct l_linenumber // 4) from lineitem where l_orderkey = o_orderkey) as p from orders),
r as (select k, case when p = 0 or k % 17 = 0 or (k % 7 = 0 and p = 1) then 'not landed'
                     when k % 13 = 0 or k % 11 = 0 then 'failed' when k % 7 = 0 then 'incomplete chain' end as reason from n)
select 'orders/' || k || '/lines' as request_key, reason from r where reason is not null
""")
def q_fan_out_coverage(spark, sf_dir):
    """Requests of a fan-out without a whole answer."""
    return RN.missing_requests(_order_requests(spark, sf_dir), FX.land(_withheld_lines(spark, sf_dir), dialect=PG.ODATA), PG.ODATA)


@query("q_expected_items", """
select l_orderkey as order_key, l_linenumber, l_partkey from lineitem join orders on o_orderkey = l_orderkey
where o_orderstatus = 'F' and l_orderkey % 17 <> 0 and l_orderkey % 13 <> 0 and l_orderkey % 11 <> 0 and l_orderkey % 7 <> 0
""")
def q_expected_items(spark, sf_dir):
    """Items of the expected requests only, of those with a whole answer."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    expected = RN.request_keys(orders, F.concat(F.lit("orders/"), s("o_orderkey"), F.lit("/lines")))
    pages = FX.land(_withheld_lines(spark, sf_dir), dialect=PG.ODATA)
    return TP.landed_items(pages, PG.ODATA, "struct<l_linenumber:bigint,l_partkey:bigint>",
                           {"order_key": TP.parent_id(r"^orders/(\d+)/lines$").cast("bigint")}, "skip", expected)


@query("q_tp_gateways_withheld", """
select cast(n_regionkey as varchar) as gatewayId, cast(n_nationkey as varchar) as id, n_name as datasourceName from nation
""")
def q_tp_gateways_withheld(spark, sf_dir):
    """The stored datasources after two later runs: one lost the datasources of a
    gateway, the other the users of a datasource."""
    db = _scratch_schema(spark, "withheld")
    gw, ds, us = (FX.land(p) for p in _gateway_pages(spark, sf_dir))
    TP.save_metadata(TP.build_gateways(gw, ds, us, GATEWAY_SCHEMAS, RUN_TS), db)
    stops = 0
    for d, u in ((ds.where("request_key <> 'gateways/0/datasources'"), us), (ds, us.where("request_key not like 'gateways/1/%'"))):
        try:
            TP.save_metadata(TP.build_gateways(gw, d, u, GATEWAY_SCHEMAS, "2024-06-02 12:00:00"), db)
        except PG.IncompleteChain:
            stops += 1
    if stops != 2:
        raise AssertionError("a withheld request must end the run")
    return spark.read.table(f"{db}.gateway_datasources").select("gatewayId", "id", "datasourceName")


def _setting_runs(spark, sf_dir):
    """Run 9 with all settings, and run 10 in which one has gone and the others
    have new titles."""
    first = FX.land(_setting_pages(spark, sf_dir))
    later = first.where("request_key <> 'tenantsettings/0'").withColumn("raw", F.replace("raw", F.lit('"Setting '), F.lit('"New ')))
    return first.withColumn("run_id", F.lit("9")).unionByName(later.withColumn("run_id", F.lit("10")))


@query("q_run_snapshot", f"""
select '10' as run, r_name as settingName, 'New ' || r_name as title, {TS_SQL} as extraction_timestamp from region where r_regionkey <> 0
union all
select '9', r_name, 'Setting ' || r_name, {TS_SQL} from region
""")
def q_run_snapshot(spark, sf_dir):
    """Settings of the latest run, and of an older one by request."""
    pages = _setting_runs(spark, sf_dir)
    latest = TP.build_settings(pages, SETTING, RUN_TS)["tenant_settings"].select(F.lit("10").alias("run"), "settingName", "title", "extraction_timestamp")
    older = TP.build_settings(pages, SETTING, RUN_TS, run="9")["tenant_settings"]
    return latest.unionByName(older.select(F.lit("9").alias("run"), "settingName", "title", "extraction_timestamp"))


@query("q_run_manifest", """
with n as (select l_orderkey as k, count(distinct l_linenumber // 4) as p from lineitem group by 1),
l as (select *, k % 13 = 0 or k % 11 = 0 as failed, k % 7 = 0 as gap from n where k % 17 <> 0 and not (k % 7 = 0 and p = 1))
select 'lines' as family, '2024-06-02' as run_id, count(*) as requests, count(*) filter (not failed and not gap) as complete,
       count(*) filter (failed) as failed, count(*) filter (gap and not failed) as open, true as latest from l
union all select 'lines', '2024-06-01', count(*), count(*), 0, 0, false from n
union all select 'settings', '2024-06-01', count(*), count(*), 0, 0, false from region
""")
def q_run_manifest(spark, sf_dir):
    """What each run landed of each family."""
    lines = FX.land(FX.line_pages(spark, sf_dir), dialect=PG.ODATA).withColumn("run_id", F.lit("2024-06-01")).unionByName(
        FX.land(_withheld_lines(spark, sf_dir), dialect=PG.ODATA).withColumn("run_id", F.lit("2024-06-02")))
    settings = FX.land(_setting_pages(spark, sf_dir), dialect=PG.SETTINGS).withColumn("run_id", F.lit("2024-06-01"))
    return RN.run_manifest({"lines": lines, "settings": settings}, {"lines": PG.ODATA, "settings": PG.SETTINGS})


@query("q_dataflow_quarantine", """
with f as (select o_orderkey as k from orders where o_orderstatus = 'F'),
p as (select distinct l_orderkey as k, l_linenumber // 4 as page from lineitem)
select 'dataflows/' || f.k || '/datasources' as request_key,
       case when p.page is null then 'not landed' when f.k % 13 = 0 then 'status 500' else 'unparseable body' end as reason
from f left join p on p.k = f.k where p.page is null or f.k % 13 = 0 or f.k % 11 = 0
""")
def q_dataflow_quarantine(spark, sf_dir):
    """Why stored dataflows have no sources in a run."""
    db = _scratch_schema(spark, "dataflow_lost")
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    SK.write_full_refresh(o.select(s("o_orderkey").alias("objectId")), f"{db}.dataflows", "replace")
    item = F.struct(s("l_linenumber").alias("datasourceId"))
    pages = FX.land(FX.line_pages(spark, sf_dir, "dataflows", "datasources", item, failing=True), dialect=PG.ODATA)
    return TP.build_dataflow_sources(spark, f"{db}.dataflows", pages, DATAFLOW_SOURCE, RUN_TS)[1].select("request_key", "reason")


# days ---------------------------------------------------------------------
def _two_chain_days(spark, sf_dir):
    """Activity pages with a second chain a day, still open on odd days."""
    day = F.date_format("ts", "yyyy-MM-dd")
    days = table(spark, sf_dir, "events").select(day.alias("d")).distinct()
    odd = F.substring("d", 10, 1).cast("int") % 2 == 1
    end = F.when(odd, F.lit('"continuationUri":"/more","lastResultSet":false}')).otherwise(F.lit('"lastResultSet":true}'))
    more = days.select(F.concat(F.lit("activityevents/"), "d", F.lit("/b")).alias("request_key"), F.lit(0).cast("long").alias("page_no"),
                       F.lit(200).alias("status"), F.concat(F.lit('{"activityEventEntities":[{"Id":"extra-'), "d", F.lit('"}],'), end).alias("raw"))
    return FX.land(FX.activity_pages(spark, sf_dir).unionByName(more), dialect=PG.ACTIVITY)


@query("q_whole_days", """
with d as (select 'ev-' || event_id as Id, strftime(ts, '%Y-%m-%d') as LoadDate from events)
select Id, LoadDate from d where cast(substr(LoadDate, 10, 1) as int) % 2 = 0
union all select distinct 'extra-' || LoadDate, LoadDate from d where cast(substr(LoadDate, 10, 1) as int) % 2 = 0
""")
def q_whole_days(spark, sf_dir):
    """Stored events: a day with an open chain isn't loaded at all."""
    t = f"{_scratch_schema(spark, 'whole_days')}.activity_events"
    TP.load_activity(_two_chain_days(spark, sf_dir), t, RUN_TS)
    return spark.read.table(t).select("Id", "LoadDate")


@query("q_incomplete_days", """
select distinct strftime(ts, '%Y-%m-%d') as day, 'activityevents/' || strftime(ts, '%Y-%m-%d') || '/b' as request_key,
       'incomplete chain' as reason
from events where extract(day from ts) % 2 = 1
""")
def q_incomplete_days(spark, sf_dir):
    return TP.activity_days_quarantine(_two_chain_days(spark, sf_dir))


# sinks --------------------------------------------------------------------
@query("q_replace_partition_evolve", f"""
select event_id, case when strftime(ts, '%Y-%m-%d') = '{DAY}' then null else value end as value,
       case when strftime(ts, '%Y-%m-%d') = '{DAY}' then 'n-' || event_id end as Note,
       case when strftime(ts, '%Y-%m-%d') = '{DAY}' then user_id end as "user id", strftime(ts, '%Y-%m-%d') as day
from events
""")
def q_replace_partition_evolve(spark, sf_dir):
    """A reloaded day that has new columns, lacks one and stores a narrower key."""
    t = f"{_scratch_schema(spark, 'part_evolve')}.events_by_day"
    ev = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    SK.replace_partition(ev.select("event_id", "value", "day"), t, "day")
    again = ev.where(F.col("day") == DAY).select("day", F.concat(F.lit("n-"), s("event_id")).alias("Note"),
                                                 F.col("user_id").alias("user id"), F.col("event_id").cast("int").alias("EVENT_ID"))
    SK.replace_partition(again, t, "day")
    SK.replace_partition(again, t, "day")  # twice equals once
    return spark.read.table(t)


# lines --------------------------------------------------------------------
_LINE_SQL = """'{"request_key":"orders/' || o_orderkey || '","page_no":0,"status":200,"raw":"{}"}'"""


@query("q_malformed_lines", f"""
select 'page' as kind, 'orders/' || o_orderkey as text from orders where o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0
union all
select 'malformed line', case when o_orderkey % 5 = 0 then substr({_LINE_SQL}, 1, 40) else replace({_LINE_SQL}, '200', '"ok"') end
from orders where o_orderkey % 5 = 0 or o_orderkey % 7 = 0
union all
select 'no key', '{{"page_no":0,"status":200,"raw":"{{}}"}}' from orders where o_orderkey % 11 = 0 and o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0
""")
def q_malformed_lines(spark, sf_dir):
    """A landing with cut lines, a status that is text, and lines without a key:
    its pages, and the quarantine with the lines' text."""
    key = F.col("o_orderkey")
    line = F.concat(F.lit('{"request_key":"orders/'), s("o_orderkey"), F.lit('","page_no":0,"status":200,"raw":"{}"}'))
    text = (F.when(key % 5 == 0, F.substring(line, 1, 40)).when(key % 7 == 0, F.replace(line, F.lit("200"), F.lit('"ok"')))
             .when(key % 11 == 0, F.lit('{"page_no":0,"status":200,"raw":"{}"}')).otherwise(line))
    path = scratch_path(spark, "lines", track=True)
    table(spark, sf_dir, "orders").select(text.alias("value")).write.text(path)
    pages = PG.read_pages(spark, path, malformed="skip").select(F.lit("page").alias("kind"), F.col("request_key").alias("text"))
    return pages.unionByName(PG.malformed_lines(spark, path).select(F.col("reason").alias("kind"), "text"))


# sets of tables -----------------------------------------------------------
@query("q_save_tables_failed", """
select 'nation' as table_name, n_nationkey as key, n_name as name from nation
union all select 'region', r_regionkey, r_name || ' 2' from region
""")
def q_save_tables_failed(spark, sf_dir):
    """A set whose second table fails stores none of its tables; one that was
    staged whole is put in place by the next save."""
    db = _scratch_schema(spark, "save_failed")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    SK.save_tables({"nation": nation, "region": region}, db)
    broken = region.withColumn("r_name", F.when(F.col("r_regionkey") == 3, F.raise_error(F.lit("no answer")).cast("string")).otherwise(F.lit("x")))
    try:
        SK.save_tables({"nation": nation.withColumn("n_name", F.lit("x")), "region": broken}, db)
        raise AssertionError("a failed table must end the save")
    except PySparkException:
        pass
    SK.save_tables({"region": region.withColumn("r_name", F.concat("r_name", F.lit(" 2")))}, db)
    return spark.read.table(f"{db}.nation").select(F.lit("nation").alias("table_name"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).unionByName(
        spark.read.table(f"{db}.region").select(F.lit("region").alias("table_name"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")))


# contracts ----------------------------------------------------------------
@query("q_infer_item_schema", """
with o as (select *, o_orderkey % 2 as run from orders where o_orderkey % 7 <> 0)
select 'key' as path, 'bigint' as type, count(*) as orders from o having count(*) > 0
union all select 'price', case when bool_or(run = 1) then 'double' else 'bigint' end, count(*) from o having count(*) > 0
union all select 'code', case when count(distinct run) = 2 then 'string' when bool_or(run = 1) then 'string' else 'bigint' end, count(*) from o having count(*) > 0
union all select 'customer.id', 'bigint', count(*) from o having count(*) > 0
union all select 'customer.open', 'boolean', count(*) from o where run = 1 and o_orderstatus = 'O' having count(*) > 0
union all select 'tags[]', 'string', count(*) from o where run = 0 having count(*) > 0
union all select 'never', 'string', count(*) from o having count(*) > 0
""")
def q_infer_item_schema(spark, sf_dir):
    """The contract merged from two runs of one family, each inferred from its
    complete chains (others would add a key), with the rows that hold the leaf's
    top key under it, or for a leaf of one run only those with a value."""
    o = table(spark, sf_dir, "orders", cpu_heavy=True)
    odd = F.col("o_orderkey") % 2 == 1
    lost = F.col("o_orderkey") % 7 == 0
    customer = F.concat(F.lit('{"id":'), s("o_custkey"), F.when(odd & (F.col("o_orderstatus") == "O"), F.lit(',"open":true')).otherwise(F.lit("")), F.lit("}"))
    # the price carries a half, so that it is no whole number in any engine
    body = F.concat(F.lit('{"value":[{"key":'), s("o_orderkey"), F.lit(',"price":'), s(F.floor("o_totalprice")), F.when(odd, F.lit(".5")).otherwise(F.lit("")),
                    F.lit(',"code":'), F.when(odd, F.lit('"A"')).otherwise(F.lit("7")), F.lit(',"customer":'), customer,
                    F.when(~odd, F.lit(',"tags":["x"]')).otherwise(F.lit("")), F.lit(',"never":null'),
                    F.when(lost, F.lit(',"lost":1')).otherwise(F.lit("")), F.lit("}]"), F.when(lost, F.lit(',"@odata.nextLink":"/more"')).otherwise(F.lit("")), F.lit("}"))
    pages = FX.land(o.select(F.concat(F.lit("orders/"), s("o_orderkey")).alias("request_key"), F.lit(0).cast("long").alias("page_no"),
                             F.lit(200).alias("status"), body.alias("raw")), dialect=PG.ODATA)
    number = F.regexp_extract("request_key", r"(\d+)$", 1).cast("bigint")
    db = _scratch_schema(spark, "contracts")
    for run in ("0", "1"):
        store = CS.Contracts(spark, db)
        contract = store.of("orders", pages.where(number % 2 == int(run)), PG.ODATA, run)
        store.save()
    kept = PG.unnest_pages(pages.where(number % 7 != 0), PG.ODATA)
    paths = CS.type_paths(contract)
    # '$.customer.open' of 'customer.open'; a list counts where it is there
    held = [F.struct(F.lit(p).alias("path"), F.lit(t).alias("type"),
                     F.count(F.lit(1)).alias("orders") if p == "never" else F.count(F.try_variant_get("item", "$." + p.replace("[]", ""), "variant")).alias("orders"))
            for p, t in paths]
    return kept.agg(F.array(*held).alias("held")).select(F.inline("held"))


# items --------------------------------------------------------------------
@query("q_unfit_items", """
select 'item' as kind, l_orderkey as order_key, l_linenumber as line from lineitem where not (l_orderkey % 3 = 0 and l_linenumber = 1)
union all
select 'item can''t be held as VARIANT', l_orderkey, l_linenumber from lineitem where l_orderkey % 3 = 0 and l_linenumber = 1
""")
def q_unfit_items(spark, sf_dir):
    """Bodies that no VARIANT holds, because one item repeats a key: their other
    items, and the quarantine."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    twice = F.when((key % 3 == 0) & (line == 1), F.lit(',"line":1')).otherwise(F.lit(""))
    item = F.concat(F.lit('{"order":'), s(key), F.lit(',"line":'), s(line), twice, F.lit("}"))
    li = table(spark, sf_dir, "lineitem").select(key.alias("k"), (line / F.lit(4)).cast("long").alias("page_no"), item.alias("item"))
    pages = li.groupBy(F.concat(F.lit("orders/"), s("k"), F.lit("/lines")).alias("request_key"), "page_no").agg(
        F.concat(F.lit('{"value":['), F.array_join(F.collect_list("item"), ","), F.lit("]}")).alias("raw")).withColumn("status", F.lit(200))
    landed = FX.land(pages)
    items = PG.items_as(PG.unnest_pages(landed, PG.ODATA, unfit="skip"), "struct<order:bigint,line:bigint>")
    lost = PG.unfit_items(landed, PG.ODATA)
    number = lambda name: F.regexp_extract("item_text", f'"{name}":(\\d+)', 1).cast("bigint")
    return items.select(F.lit("item").alias("kind"), F.col("order").alias("order_key"), F.col("line")).unionByName(
        lost.select(F.col("reason").alias("kind"), number("order").alias("order_key"), number("line").alias("line")))
