"""Aggregates: running totals along a chain, row counts, key inference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Pages per block in the two-level running total. A window partition never
# holds more than this many rows, however long one chain is.
RUNNING_BLOCK = 4096


def running_total(df: DataFrame, key: str, order: str, value: str, out: str,
                  block: int = RUNNING_BLOCK) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same ``key`` with
    ``order`` up to and including this row.

    A single ``Window.partitionBy(key)`` would put a whole chain into one
    task. Instead the order range is cut into blocks of ``block`` positions:
    block sums come from a partial aggregate, the (small) per-block offsets
    from a window over blocks, and the in-block total from a window over
    ``(key, block)``. ``order`` must be an integer position, unique within a
    key (a page number).
    """
    from landflow.session import bounded_broadcast

    blk = F.floor(F.col(order) / F.lit(block)).alias("_blk")
    with_blk = df.select("*", blk)
    sums = with_blk.groupBy(key, "_blk").agg(F.sum(value).alias("_bs"))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(key, "_blk", F.coalesce(F.sum("_bs").over(before), F.lit(0)).alias("_off"))
    offsets = bounded_broadcast(offsets)
    inside = Window.partitionBy(key, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_blk.join(offsets, [key, "_blk"], "left")
        .select(*df.columns, (F.col("_off") + F.sum(value).over(inside)).cast("long").alias(out))
    )


# AG1 ----------------------------------------------------------------------
def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)``, one row per table; each count is a partial
    aggregate (Parquet answers it from footers)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# AG2 ----------------------------------------------------------------------
def infer_keys(items: DataFrame, item_col: str = "item") -> DataFrame:
    """Union of keys over all records: ``(key, rows, type_name)``.

    ``type_name`` is the widest type seen for the key
    (``schema_of_variant_agg``); both aggregates combine map-side, so the
    shuffle carries one row per key and partition.
    """
    fields = F.try_variant_get(F.col(item_col), "$", "map<string,variant>")
    exploded = items.select(F.explode(fields).alias("key", "value"))
    return exploded.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.schema_of_variant_agg("value").alias("type_name"),
    )


def infer_item_schema(items: DataFrame, item_col: str = "item") -> str:
    """The inferred record type as DDL text (one small row to the driver);
    run it to draft a contract, then declare the contract."""
    row = items.select(F.schema_of_variant_agg(item_col).alias("t")).first()
    return row["t"] if row else "OBJECT<>"
