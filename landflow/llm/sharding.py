"""Sharding along a Hilbert curve, by the law ``rows``.

Language, source, size and id are quantised to equal-depth steps (texts by their
first ``PREFIX`` characters, at the values where the sorted rows reach each share),
the steps give a point on a Hilbert curve, and the rows in curve order are cut
into runs whose counts differ by one at most. A shard then covers a narrow range
of every dimension at once: ``write_shards`` stores whole rows, a folder a shard,
with each shard's least and largest values, and ``read_shards`` opens only the
shards whose ranges meet the asked ones.

Cases: nulls take the lowest step and lie in no asked range; repeated rows and
ties lie next to each other, in doc_id order; an empty table gives no rows, stored
or read; other columns are ignored by ``shard`` and stored by ``write_shards``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from landflow.session import materialize

#: Bits per dimension.
BITS = 4
#: Characters of a text dimension that count for its step.
PREFIX = 256
DIMENSIONS = ("lang", "source", "size", "doc_id")


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve index of integer points (rows, dimensions), by Skilling's transform."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


@F.pandas_udf(LongType())
def _curve(steps: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack(steps.to_numpy())) if len(steps) else [], dtype="int64")


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", _size(docs["text"]).alias("size"),
                       F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
                       "lang", "source", *more)


def _totals(rows: DataFrame, order: list[Column], value: Column) -> DataFrame:
    """``rows`` in the given order with ``before`` and ``total``: the values of all
    rows before a row, and of all. Totals go by range, so no task holds all rows."""
    spark = rows.sparkSession
    mono = F.monotonically_increasing_id()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(rows.withColumn("v", value).repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("at", mono).withColumn("part", F.shiftright("at", 33)), "shard-placed")
    # one row per range
    sums = placed.groupBy("part").agg(F.sum("v").alias("s"))
    w = Window.orderBy("part")
    offsets = sums.select("part", (F.sum("s").over(w) - F.col("s")).alias("base"), F.sum("s").over(Window.partitionBy()).alias("total"))
    return placed.join(offsets, "part")


def _text_cuts(base: DataFrame, name: str, shares: list[float]) -> list[str]:
    """The values at which the rows in order of a text column reach each share."""
    counted = base.select(F.substring(name, 1, PREFIX).alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    ranked = _totals(counted, [F.col("k")], F.col("n"))
    w = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = ranked.select("k", (F.col("base") + F.sum("v").over(w)).alias("upto"), "total")
    # one row of at most 2^bits - 1 short texts
    found = upto.agg(*[F.min(F.when(F.col("upto") >= F.lit(s) * F.col("total"), F.col("k"))).alias(f"c{i}")
                       for i, s in enumerate(shares)]).first()
    return sorted({c for c in found if c is not None})


def _placed(docs: DataFrame, shards: int, bits: int, whole: bool = False) -> DataFrame:
    """The keyed columns of every row with its shard and slot (and the row itself)."""
    base = materialize(_keyed(docs), "shard-base")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    ids = F.coalesce("doc_id", F.lit(-1))
    # two lists of 15 bounds: one small row, whatever the input
    numbers = base.agg(F.percentile_approx("size", shares, 10_000), F.percentile_approx(ids, shares, 10_000)).first()

    def step(value: Column, bounds: list) -> Column:
        return sum((F.coalesce((value > F.lit(b)).cast("int"), F.lit(0)) for b in bounds or []), F.lit(0))

    steps = [step(F.substring(c, 1, PREFIX), _text_cuts(base, c, shares)) for c in ("lang", "source")]
    steps += [step(F.col("size"), numbers[0]), step(ids, numbers[1])]
    order = [F.col("curve"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    rows = (_keyed(docs, F.struct("*").alias("row")) if whole else base).withColumn("curve", _curve(F.array(*steps)))
    placed = _totals(rows if whole else rows.drop("lang", "source"), order, F.lit(1).cast("long"))
    total, rank = F.col("total"), F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)
    each, extra = F.floor(total / shards), total % shards
    wide = extra * (each + 1)
    k = F.when(rank < wide, F.floor(rank / (each + 1))).otherwise(extra + F.floor((rank - wide) / F.greatest(each, F.lit(1))))
    slot = F.when(rank < wide, rank % (each + 1)).otherwise((rank - wide) % F.greatest(each, F.lit(1)))
    return placed.withColumns({"shard": k.cast("int"), "slot": slot.cast("long")})


def shard(docs: DataFrame, shards: int = 8, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    return _placed(docs, shards, bits).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                              F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, bits: int = BITS) -> None:
    """``path/rows``: whole rows, a folder a shard, in slot order within a file.
    ``path/manifest``: rows, and least and largest value of each dimension, by shard."""
    placed = _placed(docs, shards, bits, whole=True)
    name = "_shard"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    docs.limit(0).write.parquet(f"{path}/schema")
    # ranges are runs of the curve: a task writes to the shards that its run meets
    (placed.select("row.*", F.col("shard").alias(name), F.col("slot").alias(name + "slot")).sortWithinPartitions(name, name + "slot")
     .drop(name + "slot").write.partitionBy(name).parquet(f"{path}/rows"))
    ends = [f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("least", F.min), ("most", F.max))]
    (placed.groupBy("shard").agg(F.count("*").alias("rows"), *ends)
     .withColumn("folder", F.concat(F.lit(f"rows/{name}="), "shard")).coalesce(1).write.parquet(f"{path}/manifest"))


def matching(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> list[str]:
    """Folders of the shards that can hold rows of the ranges (a row a shard)."""
    found = spark.read.parquet(f"{path}/manifest")
    for c, (low, high) in ranges.items():
        if low is not None:
            found = found.where(F.col(f"most_{c}") >= F.lit(low))
        if high is not None:
            found = found.where(F.col(f"least_{c}") <= F.lit(high))
    return [f"{path}/{r.folder}" for r in found.select("folder").collect()]


def read_shards(spark: SparkSession, path: str, **ranges: tuple) -> DataFrame:
    """Stored rows whose ``lang``, ``source``, ``size`` and ``doc_id`` lie in the given
    (low, high) ranges, ends included, None for an open end. Other shards aren't opened."""
    if set(ranges) - set(DIMENSIONS):
        raise ValueError(f"ranges are over {DIMENSIONS}, not {sorted(set(ranges) - set(DIMENSIONS))}")
    schema = spark.read.parquet(f"{path}/schema").schema
    folders = matching(spark, path, ranges)
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    for c, (low, high) in ranges.items():
        value = _size(rows["text"]) if c == "size" else rows[c]
        if low is not None:
            rows = rows.where(value >= F.lit(low))
        if high is not None:
            rows = rows.where(value <= F.lit(high))
    return rows
