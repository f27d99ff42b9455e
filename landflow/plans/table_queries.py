"""Registered queries for the table pipelines (TP1-TP7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from landflow.plans import fixtures as FX
from landflow.plans import pipelines as TP
from landflow.plans.contracts import ACTIVITY_COLUMNS, CATCH_ALL
from landflow.plans.fixtures import DAY, PAGE, RUN_TS, s, table
from landflow.plans.queries import RUN_EPOCH_SQL, _scratch_schema, query
from landflow.sinks import tables as SK
from landflow.sources.pages import ACTIVITY, ODATA, SETTINGS, IncompleteChain, items_as, usable_items
from landflow.sources.runs import request_keys

TS_SQL = f"TIMESTAMP '{RUN_TS}'"


def _whole(tables):
    """All rows and columns of all tables, by name, with their table's name."""
    named = [df.select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), named)


# TP1 ----------------------------------------------------------------------
CAPACITY = "struct<id:string,displayName:string,admins:array<string>,users:array<struct<u:string>>>"


@query("q_tp_capacities", f"""
select cast(r_regionkey as varchar) as id, r_name as displayName,
       (select string_agg(n_name, ', ' order by n_name) from nation where n_regionkey = r_regionkey) as admins,
       {RUN_EPOCH_SQL} as extraction_timestamp
from region
""")
def q_tp_capacities(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    nl = FX.nation_names(spark, sf_dir)
    rows = r.join(nl, r.r_regionkey == nl.n_regionkey, "left").select(
        "r_regionkey",
        F.struct(s("r_regionkey").alias("id"), F.col("r_name").alias("displayName"),
                 F.col("nations").alias("admins"), F.array(F.struct(F.col("r_name").alias("u"))).alias("users")
                 ).alias("item"))
    pages = FX.chained(rows, F.lit("capacities"), F.floor(F.col("r_regionkey") / PAGE), F.col("item"), ODATA, short=True)
    return TP.build_capacities(FX.land(pages), CAPACITY, RUN_TS)


# TP6 ----------------------------------------------------------------------
SETTING = ("struct<settingName:string,title:string,enabled:boolean,tenantSettingGroup:string,"
           "enabledSecurityGroups:array<struct<graphId:string,name:string>>,"
           "properties:array<struct<name:string,value:string,type:string>>>")


@query("q_tp_settings", f"""
select 'tenant_settings' as table_name, r_name as settingName, 'Setting ' || r_name as title,
       r_regionkey % 2 = 0 as enabled, 'Region' as tenantSettingGroup, {TS_SQL} as extraction_timestamp
from region
union all by name
select 'enabled_security_groups' as table_name, r_name as settingName, cast(n_nationkey as varchar) as graphId,
       n_name as name, {TS_SQL} as extraction_timestamp
from region join nation on n_regionkey = r_regionkey
union all by name
select 'properties' as table_name, r_name as settingName, 'key' as name, cast(r_regionkey as varchar) as value,
       'Integer' as type, {TS_SQL} as extraction_timestamp
from region
union all by name
select 'properties' as table_name, r_name as settingName, 'label' as name, r_name as value,
       'String' as type, {TS_SQL} as extraction_timestamp
from region
""")
def q_tp_settings(spark, sf_dir):
    return _whole(TP.build_settings(FX.land(_setting_pages(spark, sf_dir)), SETTING, RUN_TS))


def _setting_pages(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    groups = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.collect_list(F.struct(s("n_nationkey").alias("graphId"), F.col("n_name").alias("name"))).alias("g"))
    props = F.array(
        F.struct(F.lit("key").alias("name"), s("r_regionkey").alias("value"), F.lit("Integer").alias("type")),
        F.struct(F.lit("label").alias("name"), F.col("r_name").alias("value"), F.lit("String").alias("type")))
    item = F.struct(
        F.col("r_name").alias("settingName"), F.concat(F.lit("Setting "), F.col("r_name")).alias("title"),
        (F.col("r_regionkey") % 2 == 0).alias("enabled"), F.lit("Region").alias("tenantSettingGroup"),
        F.col("g").alias("enabledSecurityGroups"), props.alias("properties"))
    rows = r.join(groups, r.r_regionkey == groups.n_regionkey, "left").select("r_regionkey", item.alias("item"))
    return FX.chained(rows, F.concat(F.lit("tenantsettings/"), s("r_regionkey")), F.lit(0), F.col("item"), SETTINGS, short=True)


@query("q_tp_settings_failed", f"""
select r_name as settingName, 'Setting ' || r_name as title, r_regionkey % 2 = 0 as enabled,
       'Region' as tenantSettingGroup, {TS_SQL} as extraction_timestamp
from region
""")
def q_tp_settings_failed(spark, sf_dir):
    """The stored settings after a second run of which one request failed."""
    db = _scratch_schema(spark, "settings")
    pages = FX.land(_setting_pages(spark, sf_dir))
    TP.save_settings(TP.build_settings(pages, SETTING, RUN_TS), db)
    status = F.when(F.col("request_key").endswith("/0"), F.lit(503)).otherwise(F.col("status"))
    try:
        TP.save_settings(TP.build_settings(pages.withColumn("status", status), SETTING, "2024-06-02 12:00:00"), db)
    except IncompleteChain:
        return spark.read.table(f"{db}.tenant_settings")
    raise AssertionError("a failed request must end the run")


# chains -------------------------------------------------------------------
@query("q_chain_complete", """
select 'orders/' || l_orderkey || '/lines' as request_key, l_linenumber, l_partkey
from lineitem
where l_orderkey % 13 <> 0 and l_orderkey % 11 <> 0 and l_orderkey % 7 <> 0 and l_orderkey % 5 <> 0 and l_orderkey % 3 <> 0
""")
def q_chain_complete(spark, sf_dir):
    """Items of complete chains: others failed (13, 11), lack their first page
    (7), were landed twice (5) or still have a link on their last page (3)."""
    pages = FX.line_pages(spark, sf_dir, failing=True)
    key = F.regexp_extract("request_key", r"^orders/(\d+)/", 1).cast("bigint")
    open_end = (key % 3 == 0) & ~F.col("raw").contains("@odata.nextLink") & F.col("raw").endswith("}")
    more = F.concat(F.expr("substring(raw, 1, length(raw) - 1)"), F.lit(',"@odata.nextLink":"more"}'))
    pages = pages.withColumn("raw", F.when(open_end, more).otherwise(F.col("raw"))).where((key % 7 != 0) | (F.col("page_no") > 0))
    pages = pages.unionByName(pages.where(key % 5 == 0))
    return items_as(usable_items(FX.land(pages), ODATA), "struct<l_linenumber:bigint,l_partkey:bigint>").drop("page_no")


@query("q_relanded_chain", """
select 'orders/' || l_orderkey || '/lines' as request_key, l_linenumber,
       l_partkey + case when l_orderkey % 13 = 0 or l_orderkey % 11 = 0 then 0 else 1000000 end as l_partkey
from lineitem
""")
def q_relanded_chain(spark, sf_dir):
    """Two runs in one landing: the later one counts where it is complete."""
    def run(run_id, shift, failing):
        item = F.struct("l_linenumber", (F.col("l_partkey") + shift).alias("l_partkey"))
        pages = FX.line_pages(spark, sf_dir, item=item, failing=failing)
        return FX.land(pages).withColumn("run_id", F.lit(run_id))
    pages = run("2024-06-01", 0, False).unionByName(run("2024-06-02", 1000000, True))
    return items_as(usable_items(pages, ODATA), "struct<l_linenumber:bigint,l_partkey:bigint>").drop("page_no")


# TP2 ----------------------------------------------------------------------
GATEWAY_SCHEMAS = {
    "gateways": "struct<id:string,name:string,publicKey:string,gatewayAnnotation:string>",
    "gateway_datasources": ("struct<id:string,datasourceName:string,"
                            "credentialDetails:struct<credentialType:string,useEndUserOAuth2Credentials:boolean>,"
                            "details:struct<server:string,location:struct<regionId:string>>>"),
    "gateway_datasource_users": ("struct<emailAddress:string,displayName:string,"
                                 "datasourceAccessRight:string,users:array<string>>"),
}


def _gateway_pages(spark, sf_dir):
    """(gateways, datasources, users): regions, nations and suppliers; a nation
    without suppliers answers with no users."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    sp = table(spark, sf_dir, "supplier")
    gw = FX.chained(r, F.lit("gateways"), F.floor(F.col("r_regionkey") / PAGE),
                    F.struct(s("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                             F.lit("pk").alias("publicKey"), F.lit("note").alias("gatewayAnnotation")), ODATA, short=True)
    ds_item = F.struct(
        s("n_nationkey").alias("id"), F.col("n_name").alias("datasourceName"),
        F.struct(F.when(F.col("n_nationkey") % 2 == 0, "Basic").otherwise("Windows").alias("credentialType"),
                 (F.col("n_nationkey") % 3 == 0).alias("useEndUserOAuth2Credentials")).alias("credentialDetails"),
        F.struct(F.col("n_name").alias("server"),
                 F.struct(s("n_regionkey").alias("regionId")).alias("location")).alias("details"))
    ds = FX.chained(n, F.concat(F.lit("gateways/"), s("n_regionkey"), F.lit("/datasources")),
                    F.floor(F.col("n_nationkey") / PAGE), ds_item, ODATA, short=True)
    sn = sp.join(n, sp.s_nationkey == n.n_nationkey)
    us_item = F.struct(F.concat(F.lit("supp-"), s("s_suppkey")).alias("emailAddress"),
                       F.col("s_name").alias("displayName"), F.lit("Read").alias("datasourceAccessRight"),
                       F.array(F.lit("x")).alias("users"))
    key = F.concat(F.lit("gateways/"), s("n_regionkey"), F.lit("/datasources/"), s("n_nationkey"), F.lit("/users"))
    us = FX.chained(sn, key, F.floor(F.col("s_suppkey") / PAGE), us_item, ODATA)
    return gw, ds, FX.answered(us, request_keys(n, key), ODATA)


@query("q_tp_gateways", f"""
select 'gateways' as table_name, cast(r_regionkey as varchar) as id, r_name as name,
       {RUN_EPOCH_SQL} as extraction_timestamp
from region
union all by name
select 'gateway_datasources' as table_name, cast(n_nationkey as varchar) as id, n_name as datasourceName,
       cast(r_regionkey as varchar) as gatewayId,
       case when n_nationkey % 2 = 0 then 'Basic' else 'Windows' end as credentialDetails_credentialType,
       n_nationkey % 3 = 0 as credentialDetails_useEndUserOAuth2Credentials,
       n_name as details_server, cast(n_regionkey as varchar) as details_location_regionId,
       {RUN_EPOCH_SQL} as extraction_timestamp
from nation join region on n_regionkey = r_regionkey
union all by name
select 'gateway_datasource_users' as table_name, 'supp-' || s_suppkey as emailAddress, s_name as displayName,
       'Read' as datasourceAccessRight, cast(n_regionkey as varchar) as gatewayId,
       cast(n_nationkey as varchar) as datasourceId, {RUN_EPOCH_SQL} as extraction_timestamp
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def q_tp_gateways(spark, sf_dir):
    gw, ds, us = _gateway_pages(spark, sf_dir)
    return _whole(TP.build_gateways(FX.land(gw), FX.land(ds), FX.land(us), GATEWAY_SCHEMAS, RUN_TS))


# TP3 ----------------------------------------------------------------------
WORKSPACE = (
    "struct<id:string,name:string,isOnDedicatedCapacity:boolean,capacityId:string,type:string,state:string,"
    "users:array<struct<identifier:string,groupUserAccessRight:string,profile:struct<id:string,kind:string>>>,"
    "reports:array<struct<id:string,name:string,users:array<string>,subscriptions:array<string>>>,"
    "datasets:array<struct<id:string,name:string,qnaQuestions:array<string>,upstreamDatasets:array<string>,"
    "users:array<string>>>,"
    "dataflows:array<struct<objectId:string,name:string,users:array<string>>>>"
)


def _workspace_pages(spark, sf_dir):
    """Orders as workspaces with their lines inline (reports, datasets,
    dataflows by return flag). The reference's record shape puts children
    inside the parent record, so a record's lists are as long as the order's
    lines: TPC-H bounds lines per order (at most 7 line numbers; 13 rows in
    the supplied data), and the grouping also splits by line-number chunk."""
    li = table(spark, sf_dir, "lineitem")
    rid = F.concat(s("l_orderkey"), F.lit("-"), s("l_linenumber"))
    rf = F.col("l_returnflag")
    lines = li.groupBy("l_orderkey", F.floor(F.col("l_linenumber") / FX.CHUNK).alias("chunk")).agg(
        F.collect_list(F.when(rf == "R", F.struct(
            rid.alias("id"), F.concat(F.lit("report-"), rid).alias("name"),
            F.array(F.lit("u")).alias("users"), F.array(F.lit("s")).alias("subscriptions")))).alias("reports"),
        F.collect_list(F.when(rf == "A", F.struct(
            rid.alias("id"), F.concat(F.lit("dataset-"), rid).alias("name"),
            F.array(s("l_partkey")).alias("qnaQuestions"), F.array(F.lit("up")).alias("upstreamDatasets"),
            F.array(F.lit("u")).alias("users")))).alias("datasets"),
        F.collect_list(F.when(rf == "N", F.struct(
            F.concat(F.lit("df-"), rid).alias("objectId"), F.concat(F.lit("dataflow-"), rid).alias("name"),
            F.array(F.lit("u")).alias("users")))).alias("dataflows"))
    o = table(spark, sf_dir, "orders", cpu_heavy=True)
    ws = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    item = F.struct(
        s("o_orderkey").alias("id"), F.concat(F.lit("ws-"), s("o_orderkey")).alias("name"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("isOnDedicatedCapacity"),
        s("o_custkey").alias("capacityId"), F.lit("Workspace").alias("type"),
        F.when(F.col("o_orderstatus") == "F", "Active").otherwise("Deleted").alias("state"),
        F.array(F.struct(F.concat(F.lit("cust-"), s("o_custkey")).alias("identifier"),
                         F.lit("Admin").alias("groupUserAccessRight"),
                         F.struct(s("o_custkey").alias("id"), F.lit("customer").alias("kind")).alias("profile"))
                ).alias("users"),
        "reports", "datasets", "dataflows")
    return FX.chained(ws, F.lit("groups"), F.floor(F.col("o_orderkey") / PAGE), item, ODATA)


_WS = "from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus = 'F'"


@query("q_tp_workspaces", f"""
select 'workspaces' as table_name, cast(o_orderkey as varchar) as id, 'ws-' || o_orderkey as name,
       o_orderpriority in ('1-URGENT', '2-HIGH') as isOnDedicatedCapacity, cast(o_custkey as varchar) as capacityId,
       'Workspace' as type, 'Active' as state, {RUN_EPOCH_SQL} as extraction_timestamp
from orders where o_orderstatus = 'F'
union all by name
select 'workspaces_users' as table_name, 'cust-' || o_custkey as identifier, 'Admin' as groupUserAccessRight,
       cast(o_orderkey as varchar) as workspace_id, 'ws-' || o_orderkey as workspace_name,
       cast(o_custkey as varchar) as profile_id, 'customer' as profile_kind, {RUN_EPOCH_SQL} as extraction_timestamp
from orders where o_orderstatus = 'F'
union all by name
select 'reports' as table_name, o_orderkey || '-' || l_linenumber as id,
       'report-' || o_orderkey || '-' || l_linenumber as name, cast(o_orderkey as varchar) as workspace_id,
       'ws-' || o_orderkey as workspace_name, {RUN_EPOCH_SQL} as extraction_timestamp
{_WS} and l_returnflag = 'R'
union all by name
select 'datasets' as table_name, o_orderkey || '-' || l_linenumber as id,
       'dataset-' || o_orderkey || '-' || l_linenumber as name, '["' || l_partkey || '"]' as qnaQuestions,
       cast(o_orderkey as varchar) as workspace_id, 'ws-' || o_orderkey as workspace_name,
       {RUN_EPOCH_SQL} as extraction_timestamp
{_WS} and l_returnflag = 'A'
union all by name
select 'dataflows' as table_name, 'df-' || o_orderkey || '-' || l_linenumber as objectId,
       'dataflow-' || o_orderkey || '-' || l_linenumber as name, cast(o_orderkey as varchar) as workspace_id,
       'ws-' || o_orderkey as workspace_name, {RUN_EPOCH_SQL} as extraction_timestamp
{_WS} and l_returnflag = 'N'
""")
def q_tp_workspaces(spark, sf_dir):
    return _whole(TP.build_workspaces(FX.land(_workspace_pages(spark, sf_dir), dialect=ODATA), WORKSPACE, RUN_TS))


# TP4 ----------------------------------------------------------------------
ACCESS_SCHEMAS = {
    "apps": "struct<id:string,name:string,lastUpdateDateTime:string>",
    "app_users": "struct<emailAddress:string,appUserAccessRight:string,profile:struct<displayName:string,segment:string>>",
    "report_users": "struct<identifier:string,reportUserAccessRight:string,profile:struct<flag:string>>",
}


@query("q_tp_access", f"""
select 'apps' as table_name, cast(n_nationkey as varchar) as id, n_name as name,
       case when n_nationkey % 5 = 0 then null
            else TIMESTAMP '2024-01-01 10:00:00' + n_nationkey * INTERVAL 1 DAY end as lastUpdateDateTime,
       {RUN_EPOCH_SQL} as extraction_timestamp
from nation
union all by name
select 'app_users' as table_name, 'cust-' || c_custkey as emailAddress, 'Viewer' as appUserAccessRight,
       cast(n_nationkey as varchar) as app_id, n_name as app_name, c_name as profile_displayName,
       c_mktsegment as profile_segment, {RUN_EPOCH_SQL} as extraction_timestamp
from customer join nation on c_nationkey = n_nationkey
union all by name
select 'report_users' as table_name, 'line-' || l_orderkey || '-' || l_linenumber as identifier,
       'Viewer' as reportUserAccessRight, cast(s_nationkey as varchar) as workspace_id,
       cast(s_suppkey as varchar) as report_id, s_name as report_name, l_returnflag as profile_flag,
       {RUN_EPOCH_SQL} as extraction_timestamp
from lineitem join supplier on l_suppkey = s_suppkey
""")
def q_tp_access(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer", cpu_heavy=True)
    sp = table(spark, sf_dir, "supplier")
    li = table(spark, sf_dir, "lineitem", cpu_heavy=True)
    updated = F.when(F.col("n_nationkey") % 5 == 0, F.lit("unknown")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad(s(F.col("n_nationkey") + 1), 2, "0"), F.lit(" 10:00:00")))
    apps = FX.chained(n, F.lit("apps"), F.floor(F.col("n_nationkey") / PAGE),
                      F.struct(s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                               updated.alias("lastUpdateDateTime")), ODATA, short=True)
    au = FX.chained(c, F.concat(F.lit("apps/"), s("c_nationkey"), F.lit("/users")), F.floor(F.col("c_custkey") / PAGE),
                    F.struct(F.concat(F.lit("cust-"), s("c_custkey")).alias("emailAddress"),
                             F.lit("Viewer").alias("appUserAccessRight"),
                             F.struct(F.col("c_name").alias("displayName"),
                                      F.col("c_mktsegment").alias("segment")).alias("profile")), ODATA)
    ls = li.join(sp.select("s_suppkey", "s_nationkey"), li.l_suppkey == sp.s_suppkey)
    ru = FX.chained(ls, F.concat(F.lit("groups/"), s("s_nationkey"), F.lit("/reports/"), s("l_suppkey"), F.lit("/users")),
                    F.floor(F.col("l_orderkey") / (100 * PAGE)),
                    F.struct(F.concat(F.lit("line-"), s("l_orderkey"), F.lit("-"), s("l_linenumber")).alias("identifier"),
                             F.lit("Viewer").alias("reportUserAccessRight"),
                             F.struct(F.col("l_returnflag").alias("flag")).alias("profile")), ODATA)
    reports = sp.select(s("s_nationkey").alias("workspace_id"), s("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    au = FX.answered(au, request_keys(n, F.concat(F.lit("apps/"), s("n_nationkey"), F.lit("/users"))), ODATA)
    ru = FX.answered(ru, request_keys(reports, F.concat(F.lit("groups/"), F.col("workspace_id"), F.lit("/reports/"), F.col("id"), F.lit("/users"))), ODATA)
    return _whole(TP.build_access(FX.land(apps), FX.land(au), FX.land(ru), reports, ACCESS_SCHEMAS, RUN_TS,
                                  include_access=True))


# TP5 ----------------------------------------------------------------------
DATAFLOW_SOURCE = ("struct<datasourceId:string,datasourceType:string,"
                   "connectionDetails:struct<server:string,database:string>>")


@query("q_tp_dataflow_sources", f"""
select cast(l_linenumber as varchar) as datasourceId, 'Sql' as datasourceType, cast(l_orderkey as varchar) as dataflowId,
       'supp-' || l_suppkey as connectionDetails_server, 'part-' || l_partkey as connectionDetails_database,
       {TS_SQL} as extraction_timestamp
from lineitem join orders on l_orderkey = o_orderkey
where o_orderstatus = 'F' and l_orderkey % 13 <> 0 and l_orderkey % 11 <> 0
""")
def q_tp_dataflow_sources(spark, sf_dir):
    db = _scratch_schema(spark, "dataflows")
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    SK.write_full_refresh(o.select(s("o_orderkey").alias("objectId"), F.concat(F.lit("dataflow-"), s("o_orderkey")).alias("name")),
                          f"{db}.dataflows", "replace")
    item = F.struct(s("l_linenumber").alias("datasourceId"), F.lit("Sql").alias("datasourceType"),
                    F.struct(F.concat(F.lit("supp-"), s("l_suppkey")).alias("server"),
                             F.concat(F.lit("part-"), s("l_partkey")).alias("database")).alias("connectionDetails"))
    pages = FX.land(FX.line_pages(spark, sf_dir, "dataflows", "datasources", item, failing=True))
    out, _quarantine = TP.build_dataflow_sources(spark, f"{db}.dataflows", pages, DATAFLOW_SOURCE, RUN_TS)
    SK.write_full_refresh(out, f"{db}.dataflow_sources", "replace")
    return spark.read.table(f"{db}.dataflow_sources")


# TP7 ----------------------------------------------------------------------
_GIVEN = ["Id", "RecordType", "CreationTime", "Operation", "UserId", "IsSuccess", "HasFullReportAttachment",
          "ExportedArtifactInfo"]
_ABSENT_SQL = ", ".join(f'cast(null as varchar) as "{c}"' for c in ACTIVITY_COLUMNS if c not in _GIVEN)
_ACTIVITY_SQL = f"""
select 'ev-' || event_id as Id,
       case when event_type = 'error' then null else cast(user_id as integer) end as RecordType,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as CreationTime,
       event_type as Operation, 'user-' || user_id as UserId,
       event_type in ('click', 'purchase') as IsSuccess,
       case event_type when 'purchase' then 'true' when 'view' then 'false' when 'signup' then 'true' end
         as HasFullReportAttachment,
       json(props)::varchar as ExportedArtifactInfo, {_ABSENT_SQL},
       'Flag,Kind,Props,Value' as extra_keys, value as extra_value, event_type as extra_kind,
       value > 50 as extra_flag, json(props)::varchar as extra_props,
       strftime(ts, '%Y-%m-%d') as LoadDate,
       {TS_SQL} as ProcessingTimestamp
from events
"""


def _activity_columns(stored):
    """All stored columns, the catch-all as its keys (in the landed record's order, which the
    fixture's VARIANT sorts) and values."""
    rest = F.from_json(CATCH_ALL, "struct<Value:double,Kind:string,Flag:boolean,Props:string>")
    return stored.withColumns({
        "extra_keys": F.array_join(F.json_object_keys(CATCH_ALL), ","), "extra_value": rest["Value"],
        "extra_kind": rest["Kind"], "extra_flag": rest["Flag"], "extra_props": rest["Props"]}).drop(CATCH_ALL)


@query("q_tp_activity_day", _ACTIVITY_SQL)
def q_tp_activity_day(spark, sf_dir):
    t = f"{_scratch_schema(spark, 'activity')}.activity_events"
    TP.load_activity(FX.land(FX.activity_pages(spark, sf_dir), dialect=ACTIVITY), t, RUN_TS)
    return _activity_columns(spark.read.table(t))


@query("q_load_activity_day", f"{_ACTIVITY_SQL} where strftime(ts, '%Y-%m-%d') = '{DAY}'")
def q_load_activity_day(spark, sf_dir):
    """One requested day out of the landing of all days."""
    t = f"{_scratch_schema(spark, 'activity_one')}.activity_events"
    TP.load_activity_day(FX.land(FX.activity_pages(spark, sf_dir), dialect=ACTIVITY), t, RUN_TS, DAY)
    return _activity_columns(spark.read.table(t))


from landflow.plans import run_queries  # noqa: E402,F401  (registers its queries)
