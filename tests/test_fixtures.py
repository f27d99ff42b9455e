from pyspark.sql import functions as F

from landflow.plans import fixtures as FX
from landflow.sources import pages as PG


def test_long_chains_shuffle_their_items_once(spark):
    """Pages are packed before they get their numbers, so that no row of the items
    is joined; null keys make no page."""
    rows = [(k, n) for k in range(3) for n in range(0, 400, k + 1)] + [(None, 1), (5, None)]
    items = spark.createDataFrame(rows, "k int, n int")
    status = F.when(F.col("k") == 1, 500).otherwise(200)
    pages = FX.chained(items, F.concat(F.lit("k/"), F.col("k")), F.floor(F.col("n") / 30) * 7, F.struct("n"), PG.ODATA, status=status)
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("collect_list")
    got = sorted((r.request_key, r.page_no, r.status, r.raw.endswith("]}")) for r in pages.collect())
    assert got == [(f"k/{k}", p, 500 if k == 1 else 200, p == 13) for k in range(3) for p in range(14)]
    found = PG.unnest_pages(pages, PG.ODATA).select("request_key", F.try_variant_get("item", "$.n", "int")).collect()
    assert sorted(tuple(r) for r in found) == sorted((f"k/{k}", n) for k, n in rows if k is not None and n is not None)
