"""Registered queries: one per operator of the inventory, each with the
DuckDB SQL that computes the same rows from the flat tables.

Every query reads the supplied tables whole; the nested inputs are derived
from them in Spark (see ``fixtures``). Aliases match between a query and its
SQL, so the compare is by column name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.functions import scalars as SF
from landflow.operators import aggregates as AG
from landflow.operators import filters as FL
from landflow.operators import links as JN
from landflow.operators import shape as PR
from landflow.plans import fixtures as FX
from landflow.plans.contracts import ACTIVITY_SCHEMA
from landflow.plans.fixtures import DAY, RUN_TS, s, table
from landflow.session import configure, scratch_path, track_schema, unique_name
from landflow.sinks import tables as SK
from landflow.sources import pages as PG

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _scratch_schema(spark: SparkSession, tag: str) -> str:
    """A fresh database whose files live in the shared checkpoint folder."""
    configure(spark)
    db = unique_name(f"lf_{tag}")
    SK.ensure_schema(spark, db, scratch_path(spark, db, track=True))
    track_schema(spark, db)
    return db


RUN_EPOCH_SQL = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', TIMESTAMP '2024-06-01 12:00:00')"

# ---------------------------------------------------------------- sources --


@query("q_read_pages", """
select 'customers/' || c_mktsegment as request_key,
       count(distinct c_custkey // 100) as pages,
       count(*) as items
from customer group by 1
""")
def q_read_pages(spark, sf_dir):
    path = scratch_path(spark, "pages", track=True)
    PG.write_pages(FX.customer_pages(spark, sf_dir), path)
    env = PG.page_envelope(PG.read_pages(spark, path), PG.ODATA)
    return env.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n_items").alias("items"))


@query("q_unnest_pages", """
select case when c_acctbal < 0 then 'debtors' else 'customers/' || c_mktsegment end as request_key,
       case when c_acctbal < 0 then c_custkey else c_custkey // 100 end as page_no,
       c_custkey, c_name
from customer
""")
def q_unnest_pages(spark, sf_dir):
    pages = FX.customer_pages(spark, sf_dir, singles_as_objects=True)
    # plus one page per chain without any payload: it gives no rows
    empty = pages.select("request_key").distinct().select(
        "request_key", F.lit(-1).cast("long").alias("page_no"), F.lit(200).alias("status"),
        F.lit('{"@odata.count":0}').alias("raw"))
    items = PG.unnest_pages(FX.land(pages.unionByName(empty)), PG.ODATA)
    return PG.items_as(items, "struct<c_custkey:bigint,c_name:string>")


_EVENT_PAGES_SQL = """
with e as (select 'users/' || user_id as request_key, event_id // 50 as page_no, event_id, event_type from events)
"""


@query("q_keep_until_terminal", _EVENT_PAGES_SQL + """
, cut as (select request_key, min(page_no) as cut from e where event_type = 'purchase' group by 1)
select e.request_key, e.page_no, e.event_id
from e left join cut on e.request_key = cut.request_key
where cut.cut is null or e.page_no <= cut.cut
""")
def q_keep_until_terminal(spark, sf_dir):
    items = PG.unnest_pages(FX.land(FX.event_pages(spark, sf_dir)), PG.ACTIVITY, with_terminal=True)
    kept = PG.keep_until_terminal(items).where(F.col("item").isNotNull())
    return PG.items_as(kept, "struct<event_id:bigint>").drop("terminal")


@query("q_page_audit", _EVENT_PAGES_SQL + """
, p as (select request_key, page_no, count(*) as n_items from e group by 1, 2)
select request_key, page_no, n_items,
       cast(sum(n_items) over (partition by request_key order by page_no
                               rows between unbounded preceding and current row) as bigint) as items_so_far
from p
""")
def q_page_audit(spark, sf_dir):
    return PG.page_audit(FX.land(FX.event_pages(spark, sf_dir), dialect=PG.ACTIVITY, count_items=True), PG.ACTIVITY)


@query("q_scan_keys", "select o_orderkey from orders")
def q_scan_keys(spark, sf_dir):
    view = unique_name("lf_orders")
    table(spark, sf_dir, "orders").createOrReplaceTempView(view)
    return PG.scan_keys(spark, view, "o_orderkey")


@query("q_split_failed", """
with p as (select distinct l_orderkey, l_linenumber // 4 as page_no from lineitem)
select case when l_orderkey % 13 = 0 or l_orderkey % 11 = 0 then 'quarantine' else 'good' end as outcome,
       case when l_orderkey % 13 = 0 then 'status 500'
            when l_orderkey % 11 = 0 then 'unparseable body' end as reason,
       count(*) as pages
from p group by 1, 2
""")
def q_split_failed(spark, sf_dir):
    good, bad = PG.split_failed(FX.land(FX.line_pages(spark, sf_dir, failing=True)))
    g = good.select(F.lit("good").alias("outcome"), F.lit(None).cast("string").alias("reason"))
    b = bad.select(F.lit("quarantine").alias("outcome"), "reason")
    return g.unionByName(b).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("pages"))


@query("q_union_pages", """
select c_custkey, c_name, cast(null as bigint) as s_suppkey, cast(null as varchar) as s_name from customer
union all
select cast(null as bigint), cast(null as varchar), s_suppkey, s_name from supplier
""")
def q_union_pages(spark, sf_dir):
    return PG.union_pages(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
    )


# ------------------------------------------------------------------ sinks --


@query("q_write_full_refresh", """
select 'nation' as table_name, n_nationkey as key, n_name as name from nation
union all
select 'region', r_regionkey, r_name from region
""")
def q_write_full_refresh(spark, sf_dir):
    db = _scratch_schema(spark, "refresh")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    SK.write_full_refresh(nation, f"{db}.nation", "strict")
    SK.write_full_refresh(nation, f"{db}.nation", "strict")      # same schema: allowed, replaces
    region = table(spark, sf_dir, "region")
    SK.write_full_refresh(nation.limit(0), f"{db}.region", "replace")
    SK.write_full_refresh(region, f"{db}.region", "replace")     # new schema taken
    return spark.read.table(f"{db}.nation").select(
        F.lit("nation").alias("table_name"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")
    ).unionByName(spark.read.table(f"{db}.region").select(
        F.lit("region").alias("table_name"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")))


@query("q_save_tables", """
select 'nation' as table_name, count(*) as rows from nation
union all select 'region', count(*) from region
union all select 'supplier', count(*) from supplier
""")
def q_save_tables(spark, sf_dir):
    db = _scratch_schema(spark, "save")
    names = ["nation", "region", "supplier"]
    SK.save_tables({n: table(spark, sf_dir, n) for n in names}, db, policy="skip")
    return AG.row_counts({n: spark.read.table(f"{db}.{n}") for n in names})


@query("q_replace_partition", f"""
select event_id,
       case when strftime(ts, '%Y-%m-%d') = '{DAY}' then value * 2 else value end as value,
       strftime(ts, '%Y-%m-%d') as day
from events
""")
def q_replace_partition(spark, sf_dir):
    db = _scratch_schema(spark, "part")
    t = f"{db}.events_by_day"
    ev = table(spark, sf_dir, "events").select(
        "event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    SK.replace_partition(ev, t, "day")
    again = ev.where(F.col("day") == DAY).withColumn("value", F.col("value") * 2)
    SK.replace_partition(again, t, "day")
    SK.replace_partition(again, t, "day")          # twice equals once
    SK.replace_partition(again.limit(0), t, "day")  # an empty load changes nothing
    return spark.read.table(t).select("event_id", "value", "day")


@query("q_empty_policy", """
with n as (select count(*) as c from region),
     e as (select count(*) as c from region where r_name = 'ATLANTIS')
select 'skip' as policy, 'all' as input, case when n.c > 0 then 'write' else 'skip' end as action,
       case when n.c > 0 then n.c end as rows_stored from n
union all
select 'skip', 'none', case when e.c > 0 then 'write' else 'skip' end, case when e.c > 0 then e.c end from e
union all
select 'write_empty', 'none', case when e.c > 0 then 'write' else 'write_empty' end, e.c from e
union all
select 'stop', 'none', case when e.c > 0 then 'write' else 'stop' end, case when e.c > 0 then e.c end from e
""")
def q_empty_policy(spark, sf_dir):
    db = _scratch_schema(spark, "empty")
    region = table(spark, sf_dir, "region")
    inputs = {"all": region, "none": region.where(F.col("r_name") == "ATLANTIS")}
    parts = []
    for i, (policy, inp) in enumerate([("skip", "all"), ("skip", "none"), ("write_empty", "none"), ("stop", "none")]):
        name = f"{db}.t{i}"
        try:
            action = SK.apply_empty_policy(inputs[inp], policy)
        except SK.EmptyInput:
            action = "stop"
        if action in ("write", "write_empty"):
            SK.write_full_refresh(inputs[inp], name, "replace")
            stored = spark.read.table(name).agg(F.count(F.lit(1)).alias("rows_stored"))
        else:
            stored = region.limit(0).agg(F.lit(None).cast("bigint").alias("rows_stored"))
        parts.append(stored.select(F.lit(policy).alias("policy"), F.lit(inp).alias("input"),
                                   F.lit(action).alias("action"), "rows_stored"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ projections --


@query("q_clean_columns", "select p_partkey, p_name, p_brand as p_brand_name from part")
def q_clean_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("p.partkey"), F.col("p_name").alias("p name"), F.col("p_brand").alias("p.brand name"))
    return PR.clean_columns(part)


@query("q_keep_columns", "select s_suppkey, s_name, cast(null as varchar) as s_phone from supplier")
def q_keep_columns(spark, sf_dir):
    return PR.keep_columns(table(spark, sf_dir, "supplier"), ["s_suppkey", "s_name", "s_phone"], fill_missing=True)


@query("q_drop_columns", "select s_suppkey, s_name, s_nationkey from supplier")
def q_drop_columns(spark, sf_dir):
    return PR.drop_columns(table(spark, sf_dir, "supplier"), ["s_acctbal", "s_phone"])


def _customer_with_nation(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nested = F.struct(
        "n_name", "n_nationkey",
        F.struct("r_name", "r_regionkey").alias("region"),
        F.array("c_mktsegment").alias("tags"),
    )
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey", F.when(F.col("c_acctbal") >= 0, nested).alias("c_nation")))


_NATION_JOIN = "from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"


@query("q_flatten_struct", f"""
select c_custkey,
       case when c_acctbal >= 0 then n_name end as nation_n_name,
       case when c_acctbal >= 0 then n_nationkey end as nation_n_nationkey,
       case when c_acctbal >= 0 then r_name end as nation_region_r_name,
       case when c_acctbal >= 0 then r_regionkey end as nation_region_r_regionkey,
       case when c_acctbal >= 0 then '["' || c_mktsegment || '"]' end as nation_tags
{_NATION_JOIN}
""")
def q_flatten_struct(spark, sf_dir):
    df = PR.flatten_struct(_customer_with_nation(spark, sf_dir), "c_nation", "nation.")
    return df.withColumn("nation_tags", SF.list_to_json("nation_tags"))


@query("q_flatten_one_level", f"""
select c_custkey,
       case when c_acctbal >= 0 then n_name end as nation_n_name,
       case when c_acctbal >= 0 then n_nationkey end as nation_n_nationkey,
       case when c_acctbal >= 0 then '{{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}}' end as nation_region,
       case when c_acctbal >= 0 then '["' || c_mktsegment || '"]' end as nation_tags
{_NATION_JOIN}
""")
def q_flatten_one_level(spark, sf_dir):
    df = PR.flatten_one_level(_customer_with_nation(spark, sf_dir), "c_nation", "nation_")
    return df.select("c_custkey", "nation_n_name", "nation_n_nationkey",
                     F.to_json("nation_region").alias("nation_region"),
                     SF.list_to_json("nation_tags").alias("nation_tags"))


@query("q_null_if_not_object", """
select event_id, case when event_id % 5 = 0 then props end as props_obj from events
""")
def q_null_if_not_object(spark, sf_dir):
    e = table(spark, sf_dir, "events", cpu_heavy=True)
    m = F.col("event_id") % 5
    p = (F.when(m == 1, F.lit("{}")).when(m == 2, F.lit("[]")).when(m == 3, F.lit("oops"))
          .when(m == 4, F.lit(None).cast("string")).otherwise(F.col("props")))
    return e.select("event_id", SF.null_if_not_object(p).alias("props_obj"))


@query("q_explode_children", """
select l_linenumber, l_quantity, o_orderkey, o_custkey
from orders join lineitem on o_orderkey = l_orderkey
""")
def q_explode_children(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # chunks of consecutive rows: at most CHUNK items per parent row, even if
    # one order held a third of all lines (the parent repeats per chunk; only
    # child rows are output). The item carries a field named like a parent
    # key: the parent's value wins.
    chunk = F.floor(F.monotonically_increasing_id() / FX.CHUNK).alias("chunk")
    lines = li.groupBy("l_orderkey", chunk).agg(
        F.collect_list(F.struct("l_linenumber", "l_quantity", F.col("l_partkey").alias("o_custkey"))).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    parents = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return PR.explode_children(parents, "lines", {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"})


@query("q_explode_many", """
select 'customers' as child, c_custkey as key, c_name as name, n_nationkey, n_name
from customer join nation on c_nationkey = n_nationkey
union all
select 'suppliers', s_suppkey, s_name, n_nationkey, n_name
from supplier join nation on s_nationkey = n_nationkey
""")
def q_explode_many(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(
        F.col("c_nationkey").alias("nk"), F.floor(F.col("c_custkey") / FX.CHUNK).alias("chunk")).agg(
        F.collect_list(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))).alias("customers"))
    sp = table(spark, sf_dir, "supplier").groupBy(
        F.col("s_nationkey").alias("nk"), F.floor(F.col("s_suppkey") / FX.CHUNK).alias("chunk")).agg(
        F.collect_list(F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))).alias("suppliers"))
    n = table(spark, sf_dir, "nation")
    parents = c.unionByName(sp, allowMissingColumns=True).join(n, F.col("nk") == n.n_nationkey)
    kids = PR.explode_many(parents, {"customers": "customers", "suppliers": "suppliers"},
                           {"n_nationkey": "n_nationkey", "n_name": "n_name"})
    return kids["customers"].select(F.lit("customers").alias("child"), "*").unionByName(
        kids["suppliers"].select(F.lit("suppliers").alias("child"), "*"))


_GIVEN = ["Id", "RecordType", "CreationTime", "Operation", "UserId", "IsSuccess", "HasFullReportAttachment",
          "ExportedArtifactInfo"]
_ABSENT_SQL = ", ".join(f'cast(null as varchar) as "{f.name}"' for f in ACTIVITY_SCHEMA if f.name not in _GIVEN)


@query("q_conform", f"""
select 'ev-' || event_id as Id,
       case when event_type = 'error' then null else cast(user_id as integer) end as RecordType,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as CreationTime,
       event_type as Operation,
       'user-' || user_id as UserId,
       case when event_type in ('error', 'click') then false when event_type = 'purchase' then true end as IsSuccess,
       case event_type when 'purchase' then 'TRUE' when 'view' then 'no' when 'click' then ''
            when 'signup' then 'true' end as HasFullReportAttachment,
       json(props)::varchar as ExportedArtifactInfo, {_ABSENT_SQL}
from events
""")
def q_conform(spark, sf_dir):
    rec = FX.activity_records(spark, sf_dir).select(F.parse_json("raw").alias("doc"))
    return PR.conform(rec, "doc", ACTIVITY_SCHEMA)


@query("q_rest_map", """
select 'ev-' || event_id as Id,
       'Flag,Kind,Props,Value' as extra_keys,
       value as extra_value,
       event_type as extra_kind,
       value > 50 as extra_flag,
       json(props)::varchar as extra_props
from events
""")
def q_rest_map(spark, sf_dir):
    from landflow.plans.contracts import ACTIVITY_COLUMNS
    rec = FX.activity_records(spark, sf_dir)
    ai = rec.select(F.get_json_object("raw", "$.Id").alias("Id"),
                    PR.rest_map(F.col("raw"), ACTIVITY_COLUMNS).alias("AdditionalInfo"))
    parsed = F.from_json("AdditionalInfo", "struct<Value:double,Kind:string,Flag:boolean,Props:string>")
    keys = F.array_join(F.array_sort(F.map_keys(F.from_json("AdditionalInfo", "map<string,string>"))), ",")
    return ai.select("Id", keys.alias("extra_keys"), parsed["Value"].alias("extra_value"),
                     parsed["Kind"].alias("extra_kind"), parsed["Flag"].alias("extra_flag"),
                     parsed["Props"].alias("extra_props"))


@query("q_type_violations", """
select 'ev-' || event_id as Id, 'RecordType' as bad_field from events where event_type = 'error'
""")
def q_type_violations(spark, sf_dir):
    from landflow.plans.contracts import ACTIVITY_READ_SCHEMA
    rec = FX.activity_records(spark, sf_dir).select(F.parse_json("raw").alias("doc"))
    bad = PR.type_violations(rec, "doc", ACTIVITY_READ_SCHEMA)
    return bad.select(F.try_variant_get("doc", "$.Id", "string").alias("Id"), "bad_field")


@query("q_stamp_run", f"""
select o_orderkey, {RUN_EPOCH_SQL} as extraction_timestamp,
       '2024-06-01' as LoadDate, TIMESTAMP '{RUN_TS}' as ProcessingTimestamp
from orders
""")
def q_stamp_run(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey")
    df = PR.stamp_run(df, RUN_TS, "epoch")
    df = PR.stamp_run(df, RUN_TS, "load_date", "LoadDate")
    return PR.stamp_run(df, RUN_TS, "timestamp", "ProcessingTimestamp")


@query("q_sink_cast", """
with nl as (
  select n_regionkey,
         '[' || string_agg('"' || n_name || '"', ',' order by n_name) || ']' as nations,
         '{"n_nationkey":' || max(n_nationkey) || ',"n_name":"' || arg_max(n_name, n_nationkey) || '"}' as last_nation,
         count(*) > 4 as many
  from nation group by 1)
select r_regionkey, r_name, nl.nations, nl.last_nation, nl.many,
       cast(null as varchar) as nothing, TIMESTAMP '2024-06-01 12:00:00' as loaded_at
from region left join nl on r_regionkey = nl.n_regionkey
""")
def q_sink_cast(spark, sf_dir):
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list("n_name")).alias("nations"),
        F.max(F.struct("n_nationkey", "n_name")).alias("last_nation"),
        (F.count(F.lit(1)) > 4).alias("many"))
    r = table(spark, sf_dir, "region")
    df = r.join(n, r.r_regionkey == n.n_regionkey, "left").select(
        "r_regionkey", "r_name", "nations", "last_nation", "many",
        F.lit(None).alias("nothing"), F.lit(RUN_TS).cast("timestamp").alias("loaded_at"))
    return SK.sink_cast(df)


# -------------------------------------------------------------- functions --


@query("q_object_to_text", """
select n_nationkey, cast(n_nationkey as varchar) as key_text,
       case when n_regionkey <> 0 then '{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' end as obj_text,
       n_name as name_text
from nation
""")
def q_object_to_text(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    obj = F.when(F.col("n_regionkey") != 0, F.struct("n_name", "n_regionkey"))
    df = n.select("n_nationkey", obj.alias("obj"))
    return n.select(
        "n_nationkey",
        SF.object_to_text("n_nationkey", n.schema["n_nationkey"].dataType).alias("key_text"),
        SF.object_to_text(obj, df.schema["obj"].dataType).alias("obj_text"),
        SF.object_to_text("n_name", n.schema["n_name"].dataType).alias("name_text"),
    )


@query("q_list_to_json", """
select r_regionkey, r_name,
       (select '[' || string_agg('"' || n_name || '"', ',' order by n_name) || ']'
        from nation where n_regionkey = r_regionkey) as nations_json
from region
""")
def q_list_to_json(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    nl = FX.nation_names(spark, sf_dir)
    df = r.join(nl, r.r_regionkey == nl.n_regionkey, "left")
    return df.select("r_regionkey", SF.list_to_json("r_name", df.schema["r_name"].dataType).alias("r_name"),
                     SF.list_to_json("nations", df.schema["nations"].dataType).alias("nations_json"))


@query("q_join_list", """
select r_regionkey,
       (select string_agg(n_name, ', ' order by n_name) from nation where n_regionkey = r_regionkey) as admins
from region
""")
def q_join_list(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    nl = FX.nation_names(spark, sf_dir)
    df = r.join(nl, r.r_regionkey == nl.n_regionkey, "left")
    return df.select("r_regionkey", SF.join_list("nations", ", ", df.schema["nations"].dataType).alias("admins"))


@query("q_strip_zone", """
select o_orderkey, case when o_orderkey % 9 = 0 then null else date_trunc('second', o_orderdate) end as order_time
from orders
""")
def q_strip_zone(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit("not a time")).otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
    return o.select("o_orderkey", SF.strip_zone(text).alias("order_time"))


@query("q_to_time_or_null", """
select o_orderkey,
       case when o_orderkey % 7 = 0 then null else date_trunc('second', o_orderdate) end as parsed,
       case when o_orderkey % 7 = 0 then null else date_trunc('second', o_orderdate) end as parsed_fmt
from orders
""")
def q_to_time_or_null(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    bad = F.col("o_orderkey") % 7 == 0
    iso = F.when(bad, F.lit("bad")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    dmy = F.when(bad, F.lit("31/02/x")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
    return o.select("o_orderkey", SF.to_time_or_null(iso).alias("parsed"),
                    SF.to_time_or_null(dmy, "dd/MM/yyyy HH:mm:ss").alias("parsed_fmt"))


@query("q_nullable_bool", """
select l_orderkey, l_linenumber,
       case when l_returnflag = 'N' then null when l_linestatus = 'O' then true else false end as flag
from lineitem
""")
def q_nullable_bool(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    text = (F.when(F.col("l_returnflag") == "N", F.lit("maybe"))
             .when(F.col("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("false")))
    return li.select("l_orderkey", "l_linenumber", SF.nullable_bool(text).alias("flag"))


_TRUTH_SQL = """
select l_orderkey, l_linenumber,
       case when l_returnflag = 'R' and l_linestatus = 'O' then true
            when l_returnflag = 'R' then false
            when l_returnflag = 'A' and l_linestatus = 'O' then true
            when l_returnflag = 'A' then false
            when l_linestatus = 'O' then l_linenumber <> 1
            else false end as is_success
from lineitem
"""


@query("q_truthy", _TRUTH_SQL)
def q_truthy(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", cpu_heavy=True)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    value = (F.when((rf == "R") & (ls == "O"), F.lit("true"))
              .when(rf == "R", F.lit("false"))
              .when((rf == "A") & (ls == "O"), F.lit('"false"'))
              .when(rf == "A", F.lit('""'))
              .when(ls == "O", s(F.col("l_linenumber") - 1)))
    doc = F.parse_json(F.when(value.isNotNull(), F.concat(F.lit('{"f":'), value, F.lit("}"))).otherwise(F.lit("{}")))
    return li.select("l_orderkey", "l_linenumber", SF.truthy(F.try_variant_get(doc, "$.f", "variant")).alias("is_success"))


@query("q_text_to_bool", """
select l_orderkey, l_linenumber,
       case when l_returnflag = 'N' and l_linestatus = 'F' then 'true'
            when l_returnflag = 'R' then 'true'
            when l_returnflag = 'A' then 'false'
            else null end as attachment
from lineitem
""")
def q_text_to_bool(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", cpu_heavy=True)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    value = (F.when((rf == "N") & (ls == "F"), F.lit("true"))
              .when(rf == "R", F.lit('"TRUE"')).when(rf == "A", F.lit('"no"')).otherwise(F.lit('""')))
    v = F.parse_json(value)
    return li.select("l_orderkey", "l_linenumber", SF.text_to_bool(v).alias("attachment"))


@query("q_epoch_seconds", """
select o_orderkey, date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o_orderdate) as order_epoch from orders
""")
def q_epoch_seconds(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", SF.epoch_seconds("o_orderdate", o.schema["o_orderdate"].dataType).alias("order_epoch"))


@query("q_run_day", """
select o_orderkey,
       case when o_orderkey % 10 in (0, 1) then '2024-05-31' else strftime(o_orderdate, '%Y-%m-%d') end as run_day
from orders
""")
def q_run_day(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    m = F.col("o_orderkey") % 10
    text = (F.when(m == 0, F.lit("bad-day")).when(m == 1, F.lit(None).cast("string"))
             .when(m == 2, F.date_format("o_orderdate", "yyyy-M-d"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", SF.run_day(text, F.lit(RUN_TS).cast("timestamp_ntz")).alias("run_day"))


@query("q_day_bounds", """
select o_orderkey,
       '''' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00.000Z''' as start_bound,
       '''' || strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59.000Z''' as end_bound
from orders
""")
def q_day_bounds(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    start, end = SF.day_bounds(F.col("o_orderdate"))
    return o.select("o_orderkey", start.alias("start_bound"), end.alias("end_bound"))


# ---------------------------------------------------------------- filters --


@query("q_where_active", """
select o_orderkey, o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'O'
""")
def q_where_active(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return FL.where_active(o, "o_orderpriority", "o_orderstatus", "1-URGENT", "O").select("o_orderkey", "o_custkey")


@query("q_where_day", f"""
select event_id, ts from events
where ts >= TIMESTAMP '{DAY} 00:00:00' and ts < TIMESTAMP '{DAY} 00:00:00' + INTERVAL 1 DAY
""")
def q_where_day(spark, sf_dir):
    return FL.where_day(table(spark, sf_dir, "events"), "ts", DAY).select("event_id", "ts")


@query("q_where_key_present", """
select c_custkey, cast(c_custkey as varchar) as parent_id from customer
where not (c_acctbal < 0) and c_mktsegment <> 'MACHINERY'
""")
def q_where_key_present(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(s("c_custkey")))
    return FL.where_key_present(c.select("c_custkey", key.alias("parent_id")), "parent_id")


# ------------------------------------------------------------------ joins --


@query("q_attach_children", """
select l_linenumber, l_quantity, o_orderkey, o_custkey
from lineitem join orders on l_orderkey = o_orderkey
""")
def q_attach_children(spark, sf_dir):
    from landflow.plans.pipelines import parent_id
    pages = FX.land(FX.line_pages(spark, sf_dir))
    items = PG.unnest_pages(pages.select("request_key", "page_no", "raw",
                                         parent_id(r"^orders/(\d+)/lines$").cast("bigint").alias("_order")),
                            PG.ODATA, keep=("_order",))
    items = PG.items_as(items, "struct<l_linenumber:int,l_quantity:double>").drop("request_key", "page_no")
    orders = table(spark, sf_dir, "orders")
    out = JN.attach_children(orders, items, {"_order": "o_orderkey"}, {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"})
    return out.drop("_order")


@query("q_restrict_to_keys", """
select o_orderkey, o_custkey, o_orderstatus from orders
where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')
""")
def q_restrict_to_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    keys = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return JN.restrict_to_keys(o, keys, {"o_custkey": "c_custkey"})


# ------------------------------------------------------------- aggregates --

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("q_row_counts", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as rows from {t}" for t in ALL_TABLES))
def q_row_counts(spark, sf_dir):
    return AG.row_counts({t: table(spark, sf_dir, t) for t in ALL_TABLES})


@query("q_infer_keys", """
select 'id' as key, count(*) as rows, 'number' as kind from events
union all select 'type', count(*), 'string' from events
union all select 'value', count(*), 'number' from events where event_type <> 'click'
union all select 'user', count(*), 'number' from events where user_id % 3 <> 0
union all select 'props', count(*), 'object' from events
""")
def q_infer_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events", cpu_heavy=True)
    rec = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
        F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user"),
        F.parse_json("props").alias("props")))
    keys = AG.infer_keys(e.select(F.parse_json(rec).alias("item")))
    t = F.col("type_name")
    kind = (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
             .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").otherwise("number"))
    return keys.select("key", "rows", kind.alias("kind"))


from landflow.plans import table_queries  # noqa: E402,F401  (registers its queries and those of run_queries)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of the stored activity table after a full daily load."""
    return QUERIES["q_tp_activity_day"](spark, sf_dir).groupBy("LoadDate").agg(
        F.count(F.lit(1)).alias("rows"))
