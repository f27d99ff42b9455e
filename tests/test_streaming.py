import json

from landflow.session import scratch_path, unique_name
from landflow.sinks.tables import ensure_schema
from landflow.sources.pages import PAGE_SCHEMA
from landflow.streaming.activity_stream import land_activity_pages, stream_activity


def _page(day, no, ids, last):
    body = {"activityEventEntities": [{"Id": i, "CreationTime": f"{day}T01:00:00"} for i in ids],
            "lastResultSet": last}
    if not last:
        body["continuationUri"] = "next"
    return (f"activityevents/{day}", no, 200, json.dumps(body))


def test_stream_reloads_touched_days_whole(spark):
    db = unique_name("lf_stream")
    ensure_schema(spark, db, scratch_path(spark, db))
    table = f"{db}.activity_events"
    landing = scratch_path(spark, "landing")
    ckpt = scratch_path(spark, "ckpt")
    land_activity_pages(spark.createDataFrame([_page("2024-01-01", 0, ["a", "b"], True),
                                               _page("2024-01-02", 0, ["c"], False)], PAGE_SCHEMA), landing)
    q = stream_activity(spark, landing, table, ckpt, run_ts="2024-06-01 12:00:00")
    q.awaitTermination(300)
    first = sorted((r.LoadDate, r.Id) for r in spark.read.table(table).collect())
    assert first == [("2024-01-01", "a"), ("2024-01-01", "b")]  # day 2 is unfinished
    # the rest of day 2 arrives later: day 2 is reloaded from all its pages, day 1 is untouched
    land_activity_pages(spark.createDataFrame([_page("2024-01-02", 1, ["d"], True)], PAGE_SCHEMA), landing)
    q = stream_activity(spark, landing, table, ckpt, run_ts="2024-06-01 12:00:00")
    q.awaitTermination(300)
    second = sorted((r.LoadDate, r.Id) for r in spark.read.table(table).collect())
    assert second == [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "c"), ("2024-01-02", "d")]
