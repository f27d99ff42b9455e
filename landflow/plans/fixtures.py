"""Landed-page inputs derived from the supplied flat tables.

The supplied tables are flat; these builders turn them into the nested
shapes the pipelines read (paged envelopes, child lists, nested objects).
Every list is bounded: pages hold at most a page size of items (a key
divided by the page size), child lists are grouped per parent *and* key
chunk, and only fixed-size dimension tables (nation, region) are collected
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.operators.aggregates import running_total
from landflow.session import materialize, scratch_path, spread
from landflow.sources.pages import ACTIVITY, ODATA, pack_pages, read_pages, write_pages

RUN_TS = "2024-06-01 12:00:00"     # fixed run stamp so results repeat
DAY = "2024-01-15"                 # the day reloaded in partition tests
PAGE = 100                         # items per landed page
CHUNK = 1000                       # child-list chunk per parent record


def table(spark: SparkSession, sf_dir: str, name: str, cpu_heavy: bool = False) -> DataFrame:
    """A supplied table. ``cpu_heavy`` marks inputs that feed per-row JSON
    work straight from the scan: those are spread over the cores when the
    scan has fewer splits than cores (a no-op on a large input)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if cpu_heavy else df


def s(c: str | Column) -> Column:
    """Column as text."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def land(pages: DataFrame, name: str = "landing", dialect=None, count_items: bool = False) -> DataFrame:
    """Write built pages once to the shared folder (compacted Parquet
    landing) and read them back with ``read_pages``: every later pass reads
    files instead of rebuilding the pages. With ``dialect`` the envelope
    facts are landed as columns too."""
    spark = pages.sparkSession
    path = scratch_path(spark, name, track=True)
    write_pages(pages, path, fmt="parquet", dialect=dialect, count_items=count_items)
    return spread(read_pages(spark, path, fmt="parquet"))


def chained(items: DataFrame, request_key: Column, page_no: Column, item: Column, dialect,
            status: Column | None = None, short: bool = False) -> DataFrame:
    """``pack_pages`` of closed chains: pages numbered from 0 without gaps in the
    order of ``page_no``, the last of each chain terminal. ``short`` chains hold
    a few pages each."""
    if short:
        return pack_pages(items, request_key, page_no, item, dialect, status=status, renumber=True)
    keyed = items.withColumns({"_rk": request_key, "_pn": page_no.cast("long")})
    once = materialize(keyed.select("_rk", "_pn").distinct(), "places").withColumn("_one", F.lit(1))  # read four times
    places = running_total(once, "_rk", "_pn", "_one", "_place")
    ends = places.groupBy("_rk").agg(F.max("_place").alias("_end"))
    places = places.join(ends, "_rk").select("_rk", "_pn", F.col("_place") - 1, (F.col("_place") == F.col("_end")))
    # joined to whole pages: the items are shuffled once
    return pack_pages(keyed, F.col("_rk"), F.col("_pn"), item, dialect, status=status,
                      places=places.toDF("request_key", "page_no", "_no", "_closes"))


def answered(pages: DataFrame, expected: DataFrame, dialect) -> DataFrame:
    """``pages`` and an empty answer for each expected request without any."""
    none = expected.select("request_key").join(pages.select("request_key"), "request_key", "left_anti")
    return pages.unionByName(none.select("request_key", F.lit(0).cast("long").alias("page_no"), F.lit(200).alias("status"),
                                         F.lit(f'{{"{dialect.payload}":[]}}').alias("raw")))


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted nation names per region (nation is a fixed 25-row dimension)."""
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_list("n_name")).alias("nations")
    )


def customer_pages(spark: SparkSession, sf_dir: str, singles_as_objects: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer", cpu_heavy=True)
    debtor = F.col("c_acctbal") < 0
    rk = F.when(debtor, F.lit("debtors")).otherwise(F.concat(F.lit("customers/"), F.col("c_mktsegment")))
    pn = F.when(debtor, F.col("c_custkey")).otherwise(F.floor(F.col("c_custkey") / PAGE))
    if not singles_as_objects:
        rk = F.concat(F.lit("customers/"), F.col("c_mktsegment"))
        pn = F.floor(F.col("c_custkey") / PAGE)
    return pack_pages(c, rk, pn, F.struct("c_custkey", "c_name", "c_acctbal"), ODATA,
                      object_when_single=singles_as_objects)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain per user, 50 events per page at most; a page holding a
    purchase is the chain's last result set."""
    e = table(spark, sf_dir, "events", cpu_heavy=True)
    return pack_pages(
        e,
        F.concat(F.lit("users/"), s("user_id")),
        F.floor(F.col("event_id") / 50),
        F.struct("event_id", "event_type", s("ts").alias("ts")),
        ACTIVITY,
        is_last=F.col("event_type") == "purchase",
    )


def line_pages(spark: SparkSession, sf_dir: str, prefix: str = "orders", suffix: str = "lines",
               item: Column | None = None, failing: bool = False) -> DataFrame:
    """Lineitems landed per order: request ``<prefix>/<orderkey>/<suffix>``,
    four line numbers per page. With ``failing`` some pages fail: status 500
    when orderkey % 13 = 0, a cut-off body when orderkey % 11 = 0."""
    li = table(spark, sf_dir, "lineitem", cpu_heavy=True)
    item = item if item is not None else F.struct("l_linenumber", "l_quantity", "l_partkey")
    status = F.when(F.col("l_orderkey") % 13 == 0, F.lit(500)).otherwise(F.lit(200)) if failing else None
    pages = chained(
        li,
        F.concat(F.lit(f"{prefix}/"), s("l_orderkey"), F.lit(f"/{suffix}")),
        F.floor(F.col("l_linenumber") / 4),
        item,
        ODATA,
        status=status,
        short=True,
    )
    if failing:
        key = F.regexp_extract("request_key", rf"^{prefix}/(\d+)/", 1).cast("bigint")
        cut = F.expr("substring(raw, 1, length(raw) - 5)")
        pages = pages.withColumn("raw", F.when((key % 11 == 0) & (F.col("status") == 200), cut).otherwise(F.col("raw")))
    return pages


def activity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as activity records (variant ``doc`` and JSON text ``raw``)
    plus the keys of the source row. Declared fields: Id, RecordType
    (text 'bad' on error events: wrong type), CreationTime, Operation, UserId,
    IsSuccess (by event type: false, 'false', absent, true),
    HasFullReportAttachment (text 'TRUE', 'no', '' or a JSON boolean),
    ExportedArtifactInfo (props object). Extra keys: Value, Kind, Flag, Props.
    """
    e = table(spark, sf_dir, "events", cpu_heavy=True)
    et = F.col("event_type")
    is_success = (
        F.when(et == "error", F.lit("false"))
        .when(et == "click", F.lit('"false"'))
        .when(et == "view", F.lit(None))
        .when(et == "signup", F.lit('""'))
        .otherwise(F.lit("true"))
    )
    attach = (
        F.when(et == "purchase", F.lit('"TRUE"'))
        .when(et == "view", F.lit('"no"'))
        .when(et == "click", F.lit('""'))
        .when(et == "signup", F.lit("true"))
    )
    record_type = F.when(et == "error", F.lit('"bad"')).otherwise(s("user_id"))

    def field(name: str, json_value: Column) -> Column:
        return F.when(json_value.isNotNull(), F.concat(F.lit(f',"{name}":'), json_value)).otherwise(F.lit(""))

    raw = F.concat(
        F.lit('{"Id":'), F.concat(F.lit('"ev-'), s("event_id"), F.lit('"')),
        field("RecordType", record_type),
        field("CreationTime", F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('"'))),
        field("Operation", F.concat(F.lit('"'), et, F.lit('"'))),
        field("UserId", F.concat(F.lit('"user-'), s("user_id"), F.lit('"'))),
        field("IsSuccess", is_success),
        field("HasFullReportAttachment", attach),
        field("ExportedArtifactInfo", F.col("props")),
        field("Value", s("value")),
        field("Kind", F.concat(F.lit('"'), et, F.lit('"'))),
        field("Flag", F.when(F.col("value") > 50, F.lit("true")).otherwise(F.lit("false"))),
        field("Props", F.col("props")),
        F.lit("}"),
    )
    return e.select("event_id", "user_id", "ts", "event_type", "value", "props", raw.alias("raw"))


def activity_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request chain per UTC day; 100 records per page; the chain's
    highest page is the last result set (no continuation link)."""
    rec = activity_records(spark, sf_dir)
    rec = rec.withColumn("_day", F.date_format("ts", "yyyy-MM-dd")).withColumn("_pn", F.floor(F.col("event_id") / PAGE))
    return chained(rec, F.concat(F.lit("activityevents/"), F.col("_day")), F.col("_pn"), F.parse_json("raw"), ACTIVITY)
