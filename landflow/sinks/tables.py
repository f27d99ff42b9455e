"""Table loads: full refresh, replace one partition, empty-input policy,
multi-table save. Parquet tables (no Delta package here); the calls are the
same for any file-based table format Spark writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType, TimestampType

from landflow.functions.scalars import is_complex


class EmptyInput(RuntimeError):
    """Raised by the ``stop`` policy: the job ends and nothing is written."""


# PR11 ---------------------------------------------------------------------
def sink_cast(df: DataFrame) -> DataFrame:
    """Make every column sink-safe in one projection: zoned timestamps keep
    their wall clock as timestamp_ntz, lists/objects/variants become compact
    JSON text, all-null (void) columns become string. Booleans and numbers
    stay typed and nullable."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif is_complex(f.dataType):
            c = F.to_json(c)
        elif isinstance(f.dataType, NullType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# SK3 ----------------------------------------------------------------------
def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{loc}")


def _schema_of(table: str) -> str | None:
    return table.split(".")[0] if "." in table else None


def _same_schema(a: StructType, b: StructType) -> bool:
    return [(f.name.lower(), f.dataType.simpleString()) for f in a.fields] == [
        (f.name.lower(), f.dataType.simpleString()) for f in b.fields
    ]


def evolved(df: DataFrame, stored: StructType) -> DataFrame:
    """``df`` under the union of its columns and the stored ones: stored columns
    that it lacks are null, its numbers and flags become text where text is
    stored, and bigint and double meet as double. Any other change of type is
    refused."""
    new = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in stored.fields:
        got = new.pop(f.name.lower(), None)
        want = f.dataType.simpleString()
        have = got.dataType.simpleString() if got else None
        c = F.col(f"`{got.name}`") if got else F.lit(None)
        if {have, want} == {"bigint", "double"}:
            want = "double"
        elif have not in (None, want) and not (want == "string" and have in ("bigint", "double", "boolean")):
            raise ValueError(f"column {f.name} is stored as {want}, frame has {have}")
        cols.append(c.cast(want).alias(f.name))
    return df.select(*cols, *[F.col(f"`{f.name}`") for f in new.values()])


# SK4 ----------------------------------------------------------------------
def apply_empty_policy(df: DataFrame, policy: str) -> str:
    """What to do with this frame: ``write``, ``skip`` or ``write_empty``.

    ``skip`` leaves the stored table as it is when the input is empty,
    ``write_empty`` replaces it with an empty table of the declared schema,
    ``stop`` raises ``EmptyInput``. The emptiness test reads one row at most.
    """
    if policy not in ("skip", "write_empty", "stop"):
        raise ValueError(f"unknown empty policy {policy!r}")
    if not df.isEmpty():
        return "write"
    if policy == "stop":
        raise EmptyInput("input is empty; nothing loaded")
    return policy


# SK1 ----------------------------------------------------------------------
def write_full_refresh(df: DataFrame, table: str, schema_mode: str = "strict",
                       fmt: str = "parquet") -> int:
    """Replace a whole table; returns the rows written (observed during the
    write, so there is no second counting pass).

    ``strict`` refuses a frame whose schema differs from the stored table's;
    ``replace`` takes the new schema; ``evolve`` takes ``evolved``'s. Do not read ``table`` in ``df``'s plan.
    """
    db = _schema_of(table)
    if db:
        ensure_schema(df.sparkSession, db)
    return _written(_fitted(df, table, schema_mode), table, fmt)


def _fitted(df: DataFrame, table: str, schema_mode: str) -> DataFrame:
    """``df`` as ``schema_mode`` lets it replace the stored ``table``."""
    if schema_mode not in ("strict", "replace", "evolve"):
        raise ValueError(f"unknown schema mode {schema_mode!r}")
    spark = df.sparkSession
    if schema_mode == "replace" or not spark.catalog.tableExists(table):
        return df
    stored = spark.read.table(table).schema
    if schema_mode == "evolve":
        return evolved(df, stored)
    if not _same_schema(stored, df.schema):
        raise ValueError(f"schema of {table} is {stored.simpleString()}, frame has {df.schema.simpleString()}")
    return df


def _written(df: DataFrame, table: str, fmt: str) -> int:
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).saveAsTable(table)
    return int(obs.get["rows"])


# SK2 ----------------------------------------------------------------------
def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def by_name(df: DataFrame, stored: StructType) -> tuple[DataFrame, list[str]]:
    """``df`` with the stored columns' names and types, its new columns after
    them, and the new columns' definitions."""
    new = {f.name.lower(): f for f in df.schema.fields}
    if len(new) < len(df.columns):
        raise ValueError(f"columns that differ in case only: {df.columns}")
    cols = []
    for f in stored.fields:
        got = new.pop(f.name.lower(), None)
        want = f.dataType.simpleString()
        have = "void" if got is None else got.dataType.simpleString()
        wider = (have in _WHOLE and (want == "double" or want in _WHOLE[_WHOLE.index(have):])) or (
            want == "string" and have in (*_WHOLE, "double", "boolean"))
        if have not in (want, "void") and not wider:
            raise ValueError(f"column {f.name} is stored as {want}, frame has {have}")
        c = F.lit(None) if got is None else F.col(_quoted(got.name))
        cols.append(c.cast(f.dataType).alias(f.name))
    named = {n: ("string" if isinstance(f.dataType, NullType) else f.dataType.simpleString()) for n, f in new.items()}
    cols += [F.col(_quoted(f.name)).cast(named[n]).alias(f.name) for n, f in new.items()]
    return df.select(*cols), [f"{_quoted(f.name)} {named[n]}" for n, f in new.items()]


def replace_partition(df: DataFrame, table: str, part_col: str, value: str | None = None,
                      fmt: str = "parquet") -> int:
    """Idempotent load of the partitions present in ``df`` (or of the one
    partition ``value``, keeping only its rows).

    First load creates the table partitioned by ``part_col``; later loads
    overwrite only the partitions that appear in ``df`` (dynamic overwrite):
    one step per partition instead of delete-then-append, so a failure cannot
    leave a day empty. Empty input changes nothing. Returns rows written.

    Columns go by name. New ones are added to the stored table (null in the
    partitions that stay), absent ones become null; whole numbers widen to a
    stored double, and numbers and flags to stored text. Any other change of type,
    and two columns that differ in case only, are refused before anything is
    written.
    """
    spark = df.sparkSession
    if value is not None:
        df = df.where(F.col(part_col) == F.lit(value))
    if spark.conf.get("spark.sql.adaptive.enabled", "true") == "true":
        # rows of one partition value go together and AQE splits a large
        # value into advisory-size pieces: a few well-sized files per day
        # instead of one small file per task and day (skew-safe, unlike a
        # plain repartition by the column)
        df = df.hint("rebalance", part_col)
    db = _schema_of(table)
    if db:
        ensure_schema(spark, db)
    obs = Observation()
    if not spark.catalog.tableExists(table):
        cols = [c for c in df.columns if c != part_col] + [part_col]
        (df.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.format(fmt).partitionBy(part_col).saveAsTable(table))
        return int(obs.get["rows"])
    df, added = by_name(df, spark.read.table(table).schema)
    if added:
        # a table whose files lack a column reads it as null
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
    order = spark.read.table(table).columns  # insertInto is by position
    # insertInto on a catalog table follows the session setting, not a write
    # option; in static mode it would drop every partition not in ``df``
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        (df.select(*map(_quoted, order)).observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.insertInto(table, overwrite=True))
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return int(obs.get["rows"])


# SK5 ----------------------------------------------------------------------
STAGED, READY = "landflow_staged_", "landflow_staged"


def _staged(spark: SparkSession, schema: str) -> list[str]:
    """Names of the tables of a set that is written but not yet in place."""
    found = spark.sql(f"SHOW TABLES IN {_quoted(schema)} LIKE '{STAGED}*'").select("tableName").collect()
    return sorted(r["tableName"][len(STAGED):] for r in found)


def finish_save(spark: SparkSession, schema: str) -> list[str]:
    """Settle a set that an earlier ``save_tables`` left behind; returns the tables
    put in place. A set written whole (its marker is there) is moved into place, a
    set that wasn't is dropped. Repeating it changes nothing."""
    ready = spark.catalog.tableExists(f"{schema}.{READY}")
    names, db = _staged(spark, schema), _quoted(schema)
    for name in names:
        new = f"{db}.{_quoted(STAGED + name)}"
        if ready:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{_quoted(name)}")
            spark.sql(f"ALTER TABLE {new} RENAME TO {db}.{_quoted(name)}")
        else:
            spark.sql(f"DROP TABLE {new}")
    spark.sql(f"DROP TABLE IF EXISTS {db}.{_quoted(READY)}")
    return names if ready else []


def save_tables(tables: dict[str, DataFrame], schema: str, policy: str = "skip",
                schema_mode: str = "replace", shared: tuple[DataFrame, ...] = (),
                fmt: str = "parquet") -> dict[str, int | None]:
    """Save a set of tables: all of them or none.

    Every frame is written to a staged table first; an error in any of them (a
    failed read, a refused schema, the ``stop`` policy) leaves every stored table
    as it was. Then a marker is set and the staged tables are renamed into place. A
    run that dies among the renames is finished, not undone, by the next
    ``save_tables`` of the schema or by ``finish_save``: the new set is whole.
    A rename moves a folder, which an object store does by copying it.

    Returns rows written per table (None when skipped). Frames in ``shared``
    (a parent parsed once and read by several tables) are persisted for the
    duration of the writes and released afterwards.
    """
    from pyspark import StorageLevel

    result: dict[str, int | None] = {}
    if not tables:
        return result
    spark = next(iter(tables.values())).sparkSession
    ensure_schema(spark, schema)
    finish_save(spark, schema)
    for s in shared:
        s.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in tables.items():
            action = apply_empty_policy(df, policy)
            if action == "skip":
                result[name] = None
                continue
            fitted = _fitted(sink_cast(df), f"{schema}.{name}", schema_mode)
            result[name] = _written(fitted, f"{schema}.{STAGED}{name}", fmt)
        spark.sql(f"CREATE TABLE {_quoted(schema)}.{_quoted(READY)} (at STRING) USING {fmt}")
    except BaseException:
        finish_save(spark, schema)
        raise
    finally:
        for s in shared:
            s.unpersist()
    finish_save(spark, schema)
    return result
