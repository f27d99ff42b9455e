"""Session settings and the shared scratch folder.

Everything here reads the session first and only fills in what is unset, so a
cluster's own configuration (checkpoint folder, shuffle sizing) always wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the library relies on. AQE re-plans joins from runtime sizes (so a
# small side becomes a broadcast only after its real size is known), splits
# skewed partitions and coalesces small ones. Partition overwrite mode is not
# here: ``replace_partition`` sets it around its own write.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Largest side we broadcast after counting it: rows, and estimated bytes
# (rows times the schema's default row width). A page-chain cut or a
# parent-key table has one row per chain or parent, a few dozen bytes each.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


# Rows (a key and a few values each) that one task groups or sorts.
TASK_ROWS = 250_000

# Bytes of a record batch that goes to a Python worker. Spark's own bounds (10,000
# rows, 64 MB) let texts make batches of tens of MB, which the task's JVM and worker
# hold several times over and don't give back to the system.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_DEFAULTS where the session has no value of its own."""
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound record batches by BATCH_BYTES where the session has no bound of its own."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) do
    we create a folder of our own and register it. On a cluster an unset folder
    is an error: executors and driver would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="landflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str, track: bool = False) -> str:
    """A fresh, unique folder under the shared checkpoint folder. ``track``
    registers it for deletion by ``release(drop_files=True)``."""
    path = f"{checkpoint_root(spark)}/landflow/{name}-{uuid.uuid4().hex[:12]}"
    if track:
        _WRITTEN.append((spark, path))
    return path


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _width(t: T.DataType) -> int:
    # Spark's default size per type (text 20 bytes, one element per list)
    if isinstance(t, T.StructType):
        return sum(_width(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _width(t.elementType)
    if isinstance(t, T.MapType):
        return _width(t.keyType) + _width(t.valueType)
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 20
    if isinstance(t, T.VariantType):
        return 2048
    if isinstance(t, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return 8


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (Spark's default sizes)."""
    return 8 + _width(df.schema)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a derived small side only after its size is known.

    The side (a page-chain cut, a parent-key table) is persisted and counted
    in one job; it is hinted for broadcast only when the count is within
    ``max_rows`` and its estimated size within ``max_bytes``. Above the
    bound the cache is released and the frame is
    returned unhinted, so AQE plans a shuffle join with skew splitting. A
    lost executor only means the small side is recomputed from its lineage.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = kept.count()
    if rows <= max_rows and rows * row_width(df) <= max_bytes:
        _CACHED.append(kept)
        return F.broadcast(kept)
    kept.unpersist()
    return df


# Frames persisted and folders written by this library in the current
# process; ``release`` frees them once the plans that read them have run.
_CACHED: list[DataFrame] = []
_WRITTEN: list[tuple[SparkSession, str]] = []
_SCHEMAS: list[tuple[SparkSession, str]] = []


def track_schema(spark: SparkSession, name: str) -> None:
    """Register a scratch schema for dropping by ``release(drop_files=True)``."""
    _SCHEMAS.append((spark, name))


def release(drop_files: bool = False) -> None:
    """Unpersist the small sides cached by ``bounded_broadcast`` (and, with
    ``drop_files``, delete folders written by ``materialize``). Call it after
    the writes that used them, e.g. at the end of a job or a stream batch."""
    while _CACHED:
        _CACHED.pop().unpersist()
    if drop_files:
        while _SCHEMAS:
            spark, name = _SCHEMAS.pop()
            spark.sql(f"DROP SCHEMA IF EXISTS `{name}` CASCADE")
        while _WRITTEN:
            spark, path = _WRITTEN.pop()
            jvm = spark.sparkContext._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read
    it back: later plans start from the files (lineage cut, one computation,
    nothing lost with an executor)."""
    spark = df.sparkSession
    path = scratch_path(spark, name, track=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dealt(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """``df`` of at most ``rows`` rows dealt by ``cols``. Spark picks the number of
    tasks by the shuffle's compressed bytes; where that many rows are too much for
    the cores, it follows from the rows, so that a task's memory stays the same
    however large the input is."""
    parts = -(-rows // TASK_ROWS)
    few = parts <= df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(*cols) if few else df.repartition(parts, *cols)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a frame over the cluster when its scan yields fewer
    partitions than there are cores (one small file is one split). A large
    input already has more splits than cores and is returned unchanged, so
    this adds no shuffle at scale."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view: leave partitioning to Spark
        return df
    return df.repartition(want) if have < want else df
