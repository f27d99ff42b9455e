"""Table pipelines: landed pages in, flat typed tables out.

Each builder returns lazy DataFrames (one plan per table); nothing is
collected. Item contracts are arguments: a tenant declares them once (draft
them with ``infer_item_schema``).

Child pages carry their parent in the request key (for example
``gateways/<id>/datasources``); ``parent_id`` reads it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landflow.functions.scalars import join_list, to_time_or_null, truthy, text_to_bool
from landflow.operators.filters import choose, where_active, where_key_present
from landflow.operators.links import attach_children, restrict_to_keys
from landflow.operators.shape import (
    clean_columns,
    drop_columns,
    explode_many,
    flatten_struct,
    keep_columns,
    rest_map,
    stamp_run,
    type_violations,
)
from landflow.plans import contracts as C
from landflow.session import bounded_broadcast, materialize, release
from landflow.sinks.tables import EmptyInput, apply_empty_policy, replace_partition, save_tables, sink_cast
from landflow.sources.pages import (
    ACTIVITY,
    ODATA,
    SETTINGS,
    Dialect,
    IncompleteChain,
    chain_items,
    chain_status,
    items_as,
    page_columns,
    scan_keys,
    split_failed,
    usable_items,
)
from landflow.sources.runs import day_chains, expected_chains, incomplete_days, missing_requests, request_keys, snapshot


def parent_id(pattern: str, group: int = 1, col: str = "request_key") -> Column:
    """A parent id read out of the request key with a regular expression."""
    return F.nullif(F.regexp_extract(F.col(col), pattern, group), F.lit(""))


def landed_items(pages: DataFrame, dialect: Dialect, schema: StructType,
                 extra: dict[str, Column] | None = None, on_incomplete: str = "stop",
                 expected: DataFrame | None = None, chains: DataFrame | None = None) -> DataFrame:
    """Pages to typed item rows: cut each chain at its terminal page and project
    items onto the contract. A request without a complete chain ends the job
    before anything is written, or is left out (``skip``). With ``expected``
    (the requests of a fan-out) each of those must have one, and no other request
    is read; ``chains`` is the pages' chain status where it is known."""
    extra = extra or {}
    base = pages.select(*page_columns(pages), *[c.alias(n) for n, c in extra.items()])
    if expected is not None:
        items = chain_items(base, dialect, expected_chains(expected, base, dialect, on_incomplete, chains), keep=tuple(extra))
    else:
        items = usable_items(base, dialect, keep=tuple(extra), on_incomplete=on_incomplete)
    return items_as(items, schema).drop("request_key", "page_no")


def _request(*parts: str | Column) -> Column:
    """A request key; null where a part of it is null or empty."""
    cols = [F.lit(p) if isinstance(p, str) else F.nullif(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(*cols)


def _has(df: DataFrame, col: str) -> bool:
    return col in df.columns


# TP1 ----------------------------------------------------------------------
def build_capacities(pages: DataFrame, schema: StructType, run_ts: str, run: str | None = None) -> DataFrame:
    pages = snapshot({"capacities": pages}, run, ("capacities",))["capacities"]
    df = clean_columns(landed_items(pages, ODATA, schema))
    df = drop_columns(df, C.DROP["capacities"])
    if _has(df, "admins"):
        df = df.withColumn("admins", join_list("admins", ", ", df.schema["admins"].dataType))
    return stamp_run(df, run_ts, "epoch")


# TP2 ----------------------------------------------------------------------
def build_gateways(gateway_pages: DataFrame, datasource_pages: DataFrame, user_pages: DataFrame,
                   schemas: dict[str, StructType], run_ts: str, run: str | None = None) -> dict[str, DataFrame]:
    """gateways, their datasources and the datasources' users, of one run. Every
    gateway must have landed its datasources, and every datasource its users."""
    pages = snapshot({"gateways": gateway_pages, "gateway_datasources": datasource_pages,
                      "gateway_datasource_users": user_pages}, run, ("gateways",))
    gateway_pages, datasource_pages, user_pages = pages.values()
    gateways = clean_columns(landed_items(gateway_pages, ODATA, schemas["gateways"]))
    with_id = where_key_present(gateways, "id")
    ds = landed_items(datasource_pages, ODATA, schemas["gateway_datasources"],
                      {"_gw": parent_id(r"^gateways/([^/]+)/datasources$")},
                      expected=request_keys(with_id, _request("gateways/", F.col("id"), "/datasources")))
    # pair children with their parent by key, never by position
    ds = attach_children(with_id, ds, {"_gw": "id"}, {"id": "gatewayId"}).drop("_gw")
    ds = materialize(clean_columns(ds), "gateway_datasources")  # read by two tables
    ds_flat = ds
    for nested in ("credentialDetails", "details"):
        if _has(ds_flat, nested):
            ds_flat = flatten_struct(ds_flat, nested, f"{nested}_")
    users = landed_items(user_pages, ODATA, schemas["gateway_datasource_users"],
                         {"_gw": parent_id(r"^gateways/([^/]+)/datasources/([^/]+)/users$", 1),
                          "_ds": parent_id(r"^gateways/([^/]+)/datasources/([^/]+)/users$", 2)},
                         expected=request_keys(ds, _request("gateways/", F.col("gatewayId"), "/datasources/", F.col("id"), "/users")))
    users = attach_children(where_key_present(ds, "id"), users, {"_gw": "gatewayId", "_ds": "id"},
                            {"gatewayId": "gatewayId", "id": "datasourceId"}).drop("_gw", "_ds")
    users = drop_columns(clean_columns(users), C.DROP["gateway_datasource_users"])
    out = {
        "gateways": drop_columns(gateways, C.DROP["gateways"]),
        "gateway_datasources": ds_flat,
        "gateway_datasource_users": users,
    }
    return {k: stamp_run(v, run_ts, "epoch") for k, v in out.items()}


# TP3 ----------------------------------------------------------------------
def build_workspaces(pages: DataFrame, schema: StructType, run_ts: str,
                     shared_parse: bool = True, run: str | None = None) -> dict[str, DataFrame]:
    """Five tables from one parent; with ``shared_parse`` the parsed parents
    are written once to the shared folder and every table reads them."""
    pages = snapshot({"workspaces": pages}, run, ("workspaces",))["workspaces"]
    ws = where_active(landed_items(pages, ODATA, schema))
    if shared_parse:
        ws = materialize(ws, "workspaces")
    keys = {"workspace_id": "id", "workspace_name": "name"}
    children = explode_many(
        ws,
        {"users": "workspaces_users", "reports": "reports", "datasets": "datasets", "dataflows": "dataflows"},
        keys,
    )
    out = {"workspaces": clean_columns(keep_columns(ws, C.WORKSPACE_KEEP))}
    for name, df in children.items():
        df = clean_columns(df)
        if name == "workspaces_users" and _has(df, "profile"):
            df = flatten_struct(df, "profile", "profile_")
        out[name] = drop_columns(df, C.DROP.get(name, []))
    # lists left inside items (qnaQuestions, queryMetrics, ...) become JSON text
    return {k: sink_cast(stamp_run(v, run_ts, "epoch")) for k, v in out.items()}


# TP4 ----------------------------------------------------------------------
def build_access(app_pages: DataFrame, app_user_pages: DataFrame, report_user_pages: DataFrame,
                 reports: DataFrame, schemas: dict[str, StructType], run_ts: str,
                 include_access: bool, run: str | None = None) -> dict[str, DataFrame]:
    """apps, app_users, report_users; built only when ``include_access`` is
    set (the flag is required: there is no silent default). Every app and every
    report must have landed its users in the run."""
    specs = {"apps": None, "app_users": None, "report_users": None}
    if not choose(specs, {k: include_access for k in specs}):
        return {}
    pages = snapshot({"apps": app_pages, "app_users": app_user_pages, "report_users": report_user_pages}, run, ("apps",))
    app_pages, app_user_pages, report_user_pages = pages.values()
    apps = clean_columns(landed_items(app_pages, ODATA, schemas["apps"]))
    if _has(apps, "lastUpdateDateTime"):
        apps = apps.withColumn("lastUpdateDateTime", to_time_or_null("lastUpdateDateTime"))
    au = landed_items(app_user_pages, ODATA, schemas["app_users"], {"_app": parent_id(r"^apps/([^/]+)/users$")},
                      expected=request_keys(apps, _request("apps/", F.col("id"), "/users")))
    au = attach_children(apps, au, {"_app": "id"}, {"id": "app_id", "name": "app_name"}).drop("_app")
    pat = r"^groups/([^/]+)/reports/([^/]+)/users$"
    ru = landed_items(report_user_pages, ODATA, schemas["report_users"],
                      {"_ws": parent_id(pat, 1), "_rep": parent_id(pat, 2)},
                      expected=request_keys(reports, _request("groups/", F.col("workspace_id"), "/reports/", F.col("id"), "/users")))
    ru = attach_children(reports, ru, {"_ws": "workspace_id", "_rep": "id"},
                         {"workspace_id": "workspace_id", "id": "report_id", "name": "report_name"}
                         ).drop("_ws", "_rep")
    out = {"apps": apps}
    for name, df in (("app_users", au), ("report_users", ru)):
        df = clean_columns(df)
        if _has(df, "profile"):
            df = flatten_struct(df, "profile", "profile_")
        out[name] = df
    return {k: stamp_run(v, run_ts, "epoch") for k, v in out.items()}


# TP5 ----------------------------------------------------------------------
def build_dataflow_sources(spark: SparkSession, dataflows_table: str, pages: DataFrame,
                           schema: StructType, run_ts: str, run: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(dataflow_sources, quarantine). Only dataflows already stored are
    read; no stored dataflow ends the job (``EmptyInput``). A dataflow without a
    complete answer in the run is skipped whole; the quarantine has its failed
    pages, or one row that says that its chain is incomplete or never landed."""
    keys = scan_keys(spark, dataflows_table, "objectId")
    apply_empty_policy(keys, "stop")
    # keys meet pages of the run, so that no other dataflow's body is parsed
    pages = snapshot({"dataflow_datasources": pages}, run)["dataflow_datasources"]
    parent = {"dataflowId": parent_id(r"^dataflows/([^/]+)/datasources$")}
    stored = restrict_to_keys(pages.withColumn("_flow", parent["dataflowId"]), keys, {"_flow": "objectId"})
    expected = request_keys(keys, _request("dataflows/", F.col("objectId"), "/datasources"))
    base = stored.select(*page_columns(stored))
    chains = materialize(chain_status(base, ODATA), "dataflow-chains")  # read by both results
    lost = missing_requests(expected, base, ODATA, chains)
    failed = base.join(lost.where("reason = 'failed'").select("request_key"), "request_key", "left_semi")
    _, bad = split_failed(failed)
    bad = bad.unionByName(lost.where("reason <> 'failed'"), allowMissingColumns=True)
    items = landed_items(stored, ODATA, schema, parent, on_incomplete="skip", expected=expected, chains=chains)
    if _has(items, "connectionDetails"):
        items = flatten_struct(items, "connectionDetails", "connectionDetails_")
    out = sink_cast(stamp_run(clean_columns(items), run_ts, "timestamp"))
    return out, bad


# TP6 ----------------------------------------------------------------------
def build_settings(pages: DataFrame, schema: StructType, run_ts: str,
                   shared_parse: bool = True, run: str | None = None) -> dict[str, DataFrame]:
    pages = snapshot({"tenant_settings": pages}, run, ("tenant_settings",))["tenant_settings"]
    settings = landed_items(pages, SETTINGS, schema)
    if shared_parse:
        settings = materialize(settings, "settings")
    kids = explode_many(
        settings,
        {"enabledSecurityGroups": "enabled_security_groups", "properties": "properties"},
        {"settingName": "settingName"},
    )
    out = {"tenant_settings": drop_columns(settings, C.DROP["tenant_settings"]), **kids}
    return {k: stamp_run(sink_cast(v), run_ts, "timestamp") for k, v in out.items()}


# TP7 ----------------------------------------------------------------------
def page_day(pages: DataFrame) -> Column:
    """The day a page was requested for: the landed partition column, else the
    date in the request key."""
    if "day" in pages.columns:
        return F.date_format(F.col("day").cast("date"), "yyyy-MM-dd")
    return F.nullif(F.regexp_extract("request_key", r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


class IncompleteDay(IncompleteChain, EmptyInput):
    """Raised where a requested day has a failed or unfinished chain."""


def _day_pages(pages: DataFrame, day: str | None) -> DataFrame:
    """Pages with the day that they count for (``_day``): of ``day`` only (a
    literal filter on the landing's partition column), or of all days that pages
    name. Pages that name no day count as the requested one."""
    base = pages.select(*page_columns(pages))
    if "run_id" in base.columns:  # pages that name no run are of the first one
        base = base.withColumn("run_id", F.coalesce(F.col("run_id").cast("string"), F.lit("")))
    if day is not None and "day" in base.columns:
        base = base.where(F.col("day").cast("string") == day)
    at = page_day(base)
    if day is not None:
        return base.withColumn("_day", F.coalesce(at, F.lit(day))).where(F.col("_day") == day)
    return base.withColumn("_day", at).where(F.col("_day").isNotNull())


def activity_rows(pages: DataFrame, run_ts: str, day: str | None = None) -> DataFrame:
    """Landed activity pages to rows of the stored activity table.

    A day is loaded from its latest run, and only if every chain landed for it in
    that run is complete: then every event is kept under the day it was requested
    for, whatever its own clock says. A requested ``day`` that isn't complete
    raises ``IncompleteDay``; without a request such days are left out
    (``activity_days_quarantine`` tells which and why).
    """
    base = _day_pages(pages, day)
    chains = bounded_broadcast(day_chains(base, ACTIVITY))
    if day is not None:
        lost = chains.where("not complete").select("request_key").take(3)
        if lost:
            raise IncompleteDay(f"{day} has failed or unfinished chains, nothing loaded: {[r[0] for r in lost]}")
    good = chains.where("whole").drop("failed", "complete", "whole")
    # items stay JSON text: the catch-all keeps each record's key order, and
    # the declared columns come from one streaming parse per record
    items = chain_items(base, ACTIVITY, good, keep=("_day",), as_text=True)
    rows = items.select("_day", "item_text", F.from_json("item_text", C.ACTIVITY_READ_SCHEMA).alias("_r")).select(
        "_day", "item_text", *[F.col("_r").getField(f.name).alias(f.name) for f in C.ACTIVITY_READ_SCHEMA.fields])
    cols = []
    for f in C.ACTIVITY_SCHEMA.fields:
        if f.name in C.ACTIVITY_TRUTH_COLUMNS:
            cols.append(truthy(f.name).alias(f.name))
        elif f.name in C.ACTIVITY_FLAG_TEXT_COLUMNS:
            cols.append(text_to_bool(f.name).alias(f.name))
        elif f.name == C.CATCH_ALL:
            cols.append(rest_map(F.col("item_text"), C.ACTIVITY_COLUMNS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return rows.select(
        *cols,
        F.col("_day").alias(C.PARTITION),
        F.lit(run_ts).cast("timestamp_ntz").alias(C.PROCESSED_AT),
    )


def load_activity_day(pages: DataFrame, table: str, run_ts: str, day: str) -> int:
    """The daily job: load one UTC day, replacing that day only."""
    return load_activity(pages, table, run_ts, day)


def activity_days_quarantine(pages: DataFrame, day: str | None = None) -> DataFrame:
    """``(day, request_key, reason)``: why days of the landing aren't loaded."""
    return incomplete_days(_day_pages(pages, day), ACTIVITY)


def activity_quarantine(pages: DataFrame) -> DataFrame:
    """Declared fields that had a value of the wrong type (loaded as null):
    ``(Id, bad_field)``, one row per record and field, for review."""
    items = usable_items(pages.select(*page_columns(pages)), ACTIVITY)
    return type_violations(items, "item", C.ACTIVITY_READ_SCHEMA).select(
        F.try_variant_get("item", "$.Id", "string").alias("Id"), "bad_field")


def load_activity(pages: DataFrame, table: str, run_ts: str, day: str | None = None) -> int:
    """Load activity rows into ``table`` partitioned by LoadDate, replacing
    the days present. No rows ends the load (``EmptyInput``)."""
    rows = activity_rows(pages, run_ts, day)
    try:
        if rows.isEmpty():
            raise EmptyInput(f"no activity events for {day or 'any day'}")
        return replace_partition(rows, table, C.PARTITION)
    finally:
        release()


# saving -------------------------------------------------------------------
METADATA_SCHEMA = "metadata"


def save_metadata(tables: dict[str, DataFrame], schema: str = METADATA_SCHEMA) -> dict[str, int | None]:
    """Metadata tables (TP1-TP4): an empty table is skipped (the stored one
    stays). New columns are added, absent ones become null, and bigint widens to
    double; any other change of type is refused."""
    return save_tables(tables, schema, policy="skip", schema_mode="evolve")


def save_settings(tables: dict[str, DataFrame], schema: str = METADATA_SCHEMA) -> dict[str, int | None]:
    """Settings tables (TP6): an empty table replaces the stored one with an
    empty table of the declared schema, but no settings at all ends the job."""
    if "tenant_settings" in tables:
        apply_empty_policy(tables["tenant_settings"], "stop")
    return save_tables(tables, schema, policy="write_empty", schema_mode="replace")


def save_dataflow_sources(df: DataFrame, schema: str = METADATA_SCHEMA) -> int:
    """Dataflow sources (TP5): no rows ends the job; the schema is replaced."""
    result = save_tables({"dataflow_sources": df}, schema, policy="stop", schema_mode="replace")
    return int(result["dataflow_sources"] or 0)
