"""Projections and reshaping: renames, whitelists, struct flattening, child
explodes, schema conformance with a catch-all column, run stamps.

All of these are narrow (no shuffle): they compile to one ``Project`` or
``Generate`` per call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from landflow.functions.scalars import epoch_seconds


def _q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


# PR1 ----------------------------------------------------------------------
def clean_name(name: str) -> str:
    return str(name).replace(".", "_").replace(" ", "_")


def clean_columns(df: DataFrame) -> DataFrame:
    """'.' and ' ' in column names become '_'. Two names that clean to the
    same text raise instead of silently giving two equal names."""
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both clean to {n!r}")
        seen[n] = old
    return df.toDF(*new)


# PR2 ----------------------------------------------------------------------
def keep_columns(df: DataFrame, names: list[str], fill_missing: bool = False,
                 fill_type: DataType | str = "string") -> DataFrame:
    """Whitelist. Absent names are skipped, or filled with typed nulls."""
    present = set(df.columns)
    cols = []
    for n in names:
        if n in present:
            cols.append(F.col(_q(n)))
        elif fill_missing:
            cols.append(F.lit(None).cast(fill_type).alias(n))
    return df.select(*cols)


# PR3 ----------------------------------------------------------------------
def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop, ignoring names that are absent."""
    return df.drop(*[n for n in names if n in df.columns])


# PR4 ----------------------------------------------------------------------
def _leaves(col: Column, dtype: DataType, path: list[str], recurse: bool):
    if isinstance(dtype, StructType) and (recurse or not path):
        for f in dtype.fields:
            yield from _leaves(col.getField(f.name), f.dataType, path + [f.name], recurse)
    else:
        yield col, path


def flatten_struct(df: DataFrame, col: str, prefix: str | None = None, recurse: bool = True) -> DataFrame:
    """Spread a struct column into prefixed columns.

    A column that is not a struct holds no objects and is dropped. Nested
    structs recurse (``a.b`` becomes ``prefix + a_b``); lists and maps
    stay whole. A null or empty object gives nulls on the same row. The source
    column is dropped and the new columns are appended.
    """
    if col not in df.columns:
        return df
    dtype = df.schema[col].dataType
    if not isinstance(dtype, StructType):
        # no value is an object (e.g. a key that only held null, inferred as
        # text): nothing to spread, and the column goes, as with all-null
        return df.drop(col)
    prefix = f"{col}_" if prefix is None else prefix
    keep = [F.col(_q(c)) for c in df.columns if c != col]
    flat = [
        c.alias(clean_name(prefix + ".".join(path)))
        for c, path in _leaves(F.col(_q(col)), dtype, [], recurse)
    ]
    return df.select(*keep, *flat)


# PR5 ----------------------------------------------------------------------
def flatten_one_level(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """Like ``flatten_struct`` but one level only; deeper structs stay as
    they are."""
    return flatten_struct(df, col, prefix, recurse=False)


# PR6 ----------------------------------------------------------------------
def explode_children(df: DataFrame, array_col: str, parent_keys: dict[str, str | Column]) -> DataFrame:
    """One row per element of an array-of-structs column, with parent keys
    stamped on it. Parent keys win over item fields of the same name; a null
    or empty array gives no rows. ``Generate`` only: no shuffle, so one huge
    parent is not a skew problem here."""
    dtype = df.schema[array_col].dataType
    if not (isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType)):
        raise TypeError(f"{array_col} is {dtype.simpleString()}, not array<struct>")
    keys = {k: (F.col(_q(v)) if isinstance(v, str) else v) for k, v in parent_keys.items()}
    item_fields = [f.name for f in dtype.elementType.fields if f.name not in keys]
    exploded = df.select(*[c.alias(k) for k, c in keys.items()], F.explode(F.col(_q(array_col))).alias("_i"))
    return exploded.select(*[F.col("_i").getField(n).alias(n) for n in item_fields], *keys.keys())


# PR7 ----------------------------------------------------------------------
def explode_many(df: DataFrame, arrays: dict[str, str], parent_keys: dict[str, str | Column]) -> dict[str, DataFrame]:
    """Several child tables from one parent frame: ``{array_col: name}`` to
    ``{name: DataFrame}``. A column that is not a list of objects (a key
    that only ever held null, inferred as text) has no children: its table is
    empty, with the parent keys as columns. The caller decides whether the
    shared parent is persisted (``save_tables(shared=...)`` does it around
    the writes)."""
    out = {}
    for col, name in arrays.items():
        if col not in df.columns:
            continue
        dtype = df.schema[col].dataType
        if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
            out[name] = explode_children(df, col, parent_keys)
        else:
            keys = [(F.col(_q(v)) if isinstance(v, str) else v).alias(k) for k, v in parent_keys.items()]
            out[name] = df.select(*keys).where(F.lit(False))
    return out


# PR8 ----------------------------------------------------------------------
def conform(df: DataFrame, doc_col: str, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project each VARIANT record onto a declared schema, in schema order.
    Missing keys are null, a value of the wrong type is null (and the row is
    kept), a nested value in a string field keeps its JSON text."""
    typed = F.try_variant_get(F.col(doc_col), "$", schema.simpleString()).alias("_typed")
    return df.select(*keep, typed).select(*keep, *[F.col("_typed").getField(f.name).alias(f.name)
                                                  for f in schema.fields])


def type_violations(df: DataFrame, doc_col: str, schema: StructType) -> DataFrame:
    """One row per record and declared field whose value is present and not
    null in the record but does not fit the declared type (``bad_field``);
    ``conform`` loads null there.

    The record is cast once (to the contract and to a key map) in its own
    projection and the checks read those two columns. The rows come from an
    ``explode`` rather than a filter: a filter on the checks would be pushed
    below the projections with the casts (and the parse) inlined once per
    field.
    """
    cols = list(df.columns)
    casts = df.select(
        "*",
        F.try_variant_get(F.col(doc_col), "$", schema.simpleString()).alias("_typed"),
        F.try_variant_get(F.col(doc_col), "$", "map<string,variant>").alias("_fields"),
    )
    checks = []
    for f in schema.fields:
        raw = F.col("_fields").getItem(f.name)
        bad = raw.isNotNull() & ~F.is_variant_null(raw) & F.col("_typed").getField(f.name).isNull()
        checks.append(F.when(bad, F.lit(f.name)))
    return casts.select(*cols, F.explode(F.array_compact(F.array(*checks))).alias("bad_field"))


def conform_text(raw: Column, schema: StructType) -> Column:
    """The same projection straight from JSON text (one parse)."""
    return F.from_json(raw, schema)


# PR9 ----------------------------------------------------------------------
def rest_map(raw: Column, known: list[str], from_text: bool = True) -> Column:
    """JSON text of all keys of a record that are not in ``known``; scalar
    types (number, boolean, null) survive, and nested values are JSON once
    (not JSON inside a string). From text the record's own key order is kept;
    from a VARIANT (``from_text=False``) keys come in sorted order."""
    if from_text:
        fields = F.from_json(raw, "map<string,variant>")
    else:
        fields = F.try_variant_get(raw, "$", "map<string,variant>")
    known_arr = F.array(*[F.lit(k) for k in known])
    return F.to_json(F.map_filter(fields, lambda k, v: ~F.array_contains(known_arr, k)))


# PR10 ---------------------------------------------------------------------
def stamp_run(df: DataFrame, run_ts: str, kind: str = "timestamp", name: str = "extraction_timestamp") -> DataFrame:
    """Add the run stamp. ``run_ts`` is an argument (UTC wall clock, no zone)
    so a re-run gives the same rows. ``kind``: ``epoch`` (whole seconds),
    ``timestamp`` (timestamp_ntz) or ``load_date`` (``yyyy-MM-dd`` text)."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    if kind == "epoch":
        value = epoch_seconds(ts)
    elif kind == "timestamp":
        value = ts
    elif kind == "load_date":
        value = F.date_format(ts, "yyyy-MM-dd")
    else:
        raise ValueError(f"unknown stamp kind {kind!r}")
    return df.withColumn(name, value)
