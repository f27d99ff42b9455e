"""Jobs: landed folders in, stored tables out, with the control flow of the
source's scheduled runs (which tables, which empty policy, which day).

Landing layout: one folder of page lines per endpoint family under a root
(names in ``LANDING``). Item contracts are declared (DDL per family) or, when
absent, inferred once per run in one distributed aggregate over its complete
chains and merged with those of earlier runs (``contract_store``).

    python -m landflow.plans.jobs activity --landing /lake/landing --table activity_events [--day 2024-01-15]
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landflow.functions.scalars import run_day
from landflow.plans import pipelines as TP
from landflow.plans.contract_store import Contracts, declared_types, sketch_from_inferred
from landflow.session import configure, release
from landflow.sinks.tables import write_full_refresh
from landflow.sources.pages import ODATA, SETTINGS, malformed_lines, read_pages
from landflow.sources.runs import latest_run, of_run

# Landing folder per endpoint family.
LANDING = {
    "capacities": "capacities",
    "gateways": "gateways",
    "gateway_datasources": "gateway_datasources",
    "gateway_datasource_users": "gateway_datasource_users",
    "workspaces": "workspaces",
    "apps": "apps",
    "app_users": "app_users",
    "report_users": "report_users",
    "dataflow_datasources": "dataflow_datasources",
    "tenant_settings": "tenant_settings",
    "activity_events": "activity_events",
}


def contract_from_inferred(ddl: str) -> StructType:
    """The inferred variant type of the items as a Spark struct; keys that only
    held null become text."""
    return declared_types(sketch_from_inferred(ddl))


def _folder(landing: str, family: str) -> str:
    return f"{landing.rstrip('/')}/{LANDING[family]}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def _pages(spark: SparkSession, landing: str, family: str, malformed: str = "stop") -> DataFrame:
    return read_pages(spark, _folder(landing, family), malformed=malformed)


def _keep_malformed(spark: SparkSession, landing: str, schema: str, families: list[str], malformed: str) -> None:
    """Where malformed lines are skipped, ``<schema>.landing_quarantine`` has them."""
    if malformed == "skip" and families:
        bad = [malformed_lines(spark, _folder(landing, f)).select(F.lit(f).alias("family"), "*") for f in families]
        write_full_refresh(reduce(DataFrame.unionByName, bad), f"{schema}.landing_quarantine", "replace")


def _landed(spark: SparkSession, landing: str, *families: str) -> bool:
    """All folders of a table group have landed (a group with a missing
    folder is skipped, like a source that returned nothing)."""
    return all(_exists(spark, _folder(landing, f)) for f in families)


def _now_utc() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def choose_day(spark: SparkSession, text: str | None, now: str | None = None) -> str:
    """The day to load: ``yyyy-MM-dd`` text, or the day before ``now``
    (UTC) when absent or not a date. One literal row, evaluated by the same
    expression as ``run_day``."""
    now = now or _now_utc()
    row = spark.range(1).select(
        run_day(F.lit(text).cast("string"), F.lit(now).cast("timestamp_ntz")).alias("d")).first()
    return row["d"]


def metadata_job(spark: SparkSession, landing: str, schema: str = TP.METADATA_SCHEMA,
                 contracts: dict[str, StructType | str] | None = None, include_access: bool = False,
                 run_ts: str | None = None, run: str | None = None, malformed: str = "stop") -> dict[str, int | None]:
    """Capacities, gateways (3 tables), workspaces (5 tables) and, when
    ``include_access``, apps, app users and report users, all of one run of the
    landing: ``run``, or the latest that any family has. Empty tables are
    skipped; returns rows written per table."""
    configure(spark)
    contracts = contracts or {}
    run_ts = run_ts or _now_utc()
    gw = ("gateways", "gateway_datasources", "gateway_datasource_users")
    access = ("apps", "app_users", "report_users")
    groups = [("capacities",), gw, ("workspaces",), *([access] if include_access else [])]
    there = [f for g in groups if _landed(spark, landing, *g) for f in g]
    p = {f: _pages(spark, landing, f, malformed) for f in there}
    run = run if run is not None else latest_run(*p.values())
    p = {f: of_run(pages, run) for f, pages in p.items()}  # contracts come from this run too

    store = Contracts(spark, schema)

    def c(family: str) -> StructType:
        return store.of(family, p[family], ODATA, run, contracts.get(family))

    tables: dict[str, DataFrame] = {}
    try:
        if "capacities" in p:
            tables["capacities"] = TP.build_capacities(p["capacities"], c("capacities"), run_ts)
        if "gateways" in p:
            tables.update(TP.build_gateways(*[p[f] for f in gw], {f: c(f) for f in gw}, run_ts))
        ws = {}
        if "workspaces" in p:
            ws = TP.build_workspaces(p["workspaces"], c("workspaces"), run_ts)
            tables.update(ws)
        if "apps" in p and "reports" in ws:
            reports = ws["reports"].select("workspace_id", "id", "name")
            tables.update(TP.build_access(*[p[f] for f in access], reports, {f: c(f) for f in access}, run_ts, include_access=True))
        _keep_malformed(spark, landing, schema, there, malformed)
        rows = TP.save_metadata(tables, schema)
        store.save()
        return rows
    finally:
        release(drop_files=True)


def settings_job(spark: SparkSession, landing: str, schema: str = TP.METADATA_SCHEMA,
                 declared: StructType | str | None = None, run_ts: str | None = None, run: str | None = None,
                 malformed: str = "stop") -> dict[str, int | None]:
    """Tenant settings and their two child tables, of one run; an empty child
    table replaces the stored one with an empty table."""
    configure(spark)
    pages = _pages(spark, landing, "tenant_settings", malformed)
    run = run if run is not None else latest_run(pages)
    pages = of_run(pages, run)
    store = Contracts(spark, schema)
    try:
        tables = TP.build_settings(pages, store.of("tenant_settings", pages, SETTINGS, run, declared), run_ts or _now_utc())
        _keep_malformed(spark, landing, schema, ["tenant_settings"], malformed)
        rows = TP.save_settings(tables, schema)
        store.save()
        return rows
    finally:
        release(drop_files=True)


def dataflow_sources_job(spark: SparkSession, landing: str, schema: str = TP.METADATA_SCHEMA,
                         declared: StructType | str | None = None, run_ts: str | None = None, run: str | None = None,
                         malformed: str = "stop") -> int:
    """Datasources of the dataflows already stored in ``<schema>.dataflows``, of
    one run; no stored dataflow or no datasource ends the job (``EmptyInput``).
    Failed pages, unfinished chains and dataflows that never landed are kept in
    ``dataflow_sources_quarantine``."""
    configure(spark)
    pages = _pages(spark, landing, "dataflow_datasources", malformed)
    run = run if run is not None else latest_run(pages)
    pages = of_run(pages, run)
    store = Contracts(spark, schema)
    try:
        out, quarantine = TP.build_dataflow_sources(spark, f"{schema}.dataflows", pages,
                                                    store.of("dataflow_datasources", pages, ODATA, run, declared), run_ts or _now_utc())
        _keep_malformed(spark, landing, schema, ["dataflow_datasources"], malformed)
        write_full_refresh(quarantine, f"{schema}.dataflow_sources_quarantine", "replace")
        rows = TP.save_dataflow_sources(out, schema)
        store.save()
        return rows
    finally:
        release(drop_files=True)


def activity_job(spark: SparkSession, landing: str, table: str, day: str | None = None,
                 now: str | None = None) -> int:
    """The daily activity load: ``day`` (or yesterday UTC) replaces that
    day's partition of ``table``; no events end the load (``EmptyInput``), and so
    does a chain of the day that isn't complete (``IncompleteDay``)."""
    configure(spark)
    chosen = choose_day(spark, day, now)
    pages = _pages(spark, landing, "activity_events")
    return TP.load_activity_day(pages, table, now or _now_utc(), chosen)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="landflow-jobs")
    ap.add_argument("job", choices=["metadata", "settings", "dataflow_sources", "activity"])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--schema", default=TP.METADATA_SCHEMA)
    ap.add_argument("--table", default="activity_events")
    ap.add_argument("--day")
    ap.add_argument("--include-access", action="store_true")
    ap.add_argument("--run", help="the run to read (default: the latest)")
    ap.add_argument("--malformed", choices=["stop", "skip"], default="stop")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"landflow-{args.job}").getOrCreate()
    if args.job == "metadata":
        print(metadata_job(spark, args.landing, args.schema, include_access=args.include_access, run=args.run, malformed=args.malformed))
    elif args.job == "settings":
        print(settings_job(spark, args.landing, args.schema, run=args.run, malformed=args.malformed))
    elif args.job == "dataflow_sources":
        print(dataflow_sources_job(spark, args.landing, args.schema, run=args.run, malformed=args.malformed))
    else:
        print(activity_job(spark, args.landing, args.table, args.day))


if __name__ == "__main__":
    main()
