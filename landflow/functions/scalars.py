"""Column functions (built-in expressions only, so they stay in codegen).

Functions that depend on a column's type take the DataFrame type as an
argument; ``for_type`` helpers pick the expression at plan time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    NullType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_complex(dtype: DataType) -> bool:
    return isinstance(dtype, (ArrayType, MapType, StructType, VariantType))


# SF1 ----------------------------------------------------------------------
def join_list(c: ColumnOrName, sep: str = ", ", dtype: DataType | None = None) -> Column:
    """A list of strings as one string; null stays null; non-lists pass."""
    if dtype is not None and not isinstance(dtype, ArrayType):
        return _c(c)
    return F.array_join(_c(c), sep)


# SF2 ----------------------------------------------------------------------
def list_to_json(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """A list as JSON text; other values unchanged."""
    if dtype is not None and not isinstance(dtype, ArrayType):
        return _c(c)
    return F.to_json(_c(c))


# SF3 ----------------------------------------------------------------------
def object_to_text(c: ColumnOrName, dtype: DataType) -> Column:
    """Null stays null; lists, objects and variants become compact JSON;
    everything else becomes its text form."""
    if isinstance(dtype, StringType):
        return _c(c)
    if is_complex(dtype):
        return F.to_json(_c(c))
    return _c(c).cast("string")


# SF4 ----------------------------------------------------------------------
def strip_zone(c: ColumnOrName, dtype: DataType = StringType()) -> Column:
    """Drop the zone but keep the wall-clock reading.

    Text with an offset keeps its local reading (no shift to UTC); a zoned
    timestamp keeps the reading of the session zone.
    """
    if isinstance(dtype, TimestampNTZType):
        return _c(c)
    if isinstance(dtype, TimestampType):
        return _c(c).cast("timestamp_ntz")
    return _c(c).cast("string").try_cast("timestamp_ntz")


# SF5 ----------------------------------------------------------------------
def to_time_or_null(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Parse a time; text that is not a time gives null (never an error)."""
    if fmt is None:
        return _c(c).try_cast("timestamp_ntz")
    # parse straight to a zone-free time (a detour through a zoned timestamp
    # would move readings that fall in a daylight-saving gap); the zoned
    # try-parse only guards against an error on bad text
    ok = F.try_to_timestamp(_c(c), F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(_c(c), F.lit(fmt)))


# SF6 ----------------------------------------------------------------------
def nullable_bool(c: ColumnOrName, dtype: DataType = StringType()) -> Column:
    """Booleans with a null state; text that is not a boolean gives null."""
    if isinstance(dtype, BooleanType):
        return _c(c)
    if isinstance(dtype, NullType):
        return F.lit(None).cast("boolean")
    return _c(c).try_cast("boolean")


# SF7 ----------------------------------------------------------------------
def truthy(v: ColumnOrName) -> Column:
    """Python truth of a JSON value held as VARIANT.

    Absent, null, false, 0, '', [] and {} are false; every other value is
    true, including the text 'false'. The JSON type decides, so the input must
    be a variant (text alone cannot tell "0" from 0).
    """
    v = _c(v)
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(False))
        .when(kind == "BOOLEAN", F.variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.length(F.variant_get(v, "$", "string")) > 0)
        .when(kind.startswith("ARRAY"), F.to_json(v) != "[]")
        .when(kind.startswith("OBJECT"), F.to_json(v) != "{}")
        .otherwise(F.try_variant_get(v, "$", "double") != 0)
    )


# SF8 ----------------------------------------------------------------------
def text_to_bool(v: ColumnOrName) -> Column:
    """Text flag to a boolean held as text.

    'true' in any case gives 'true', '' gives null, other text 'false'. A value
    that is not text (a JSON boolean or number) passes through as its text.
    Input is a variant; output is a string column.
    """
    v = _c(v)
    kind = F.schema_of_variant(v)
    s = F.variant_get(v, "$", "string")
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
        .when(kind != "STRING", F.to_json(v))
        .when(s == "", F.lit(None).cast("string"))
        .otherwise((F.lower(s) == "true").cast("string"))
    )


# SF9 ----------------------------------------------------------------------
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_seconds(c: ColumnOrName, dtype: DataType = TimestampNTZType()) -> Column:
    """Whole seconds since 1970-01-01; a zone-free time is read as UTC."""
    if isinstance(dtype, TimestampType):
        return F.unix_seconds(_c(c))
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), _c(c))


# SF10 ---------------------------------------------------------------------
def run_day(text: ColumnOrName, now: ColumnOrName) -> Column:
    """`yyyy-MM-dd` text (one-digit months and days too), or the day before ``now`` when absent or bad."""
    parsed = F.try_to_date(_c(text), "yyyy-M-d")
    fallback = F.date_sub(F.to_date(_c(now)), 1)
    return F.date_format(F.coalesce(parsed, fallback), "yyyy-MM-dd")


# SF11 ---------------------------------------------------------------------
def day_bounds(day: ColumnOrName, quoted: bool = True) -> tuple[Column, Column]:
    """First and last second of a day as ISO text (the source's filter form).

    The source wants the bounds in single quotes; ``quoted=False`` drops them.
    """
    d = F.to_date(_c(day))
    start = F.date_format(d, "yyyy-MM-dd'T'00:00:00.000'Z'")
    end = F.date_format(d, "yyyy-MM-dd'T'23:59:59.000'Z'")
    if quoted:
        start = F.concat(F.lit("'"), start, F.lit("'"))
        end = F.concat(F.lit("'"), end, F.lit("'"))
    return start, end


# FL4 ----------------------------------------------------------------------
def null_if_not_object(c: ColumnOrName, dtype: DataType = StringType()) -> Column:
    """Keep a value only when it is a non-empty JSON object.

    For text: null, '{}', a list, a scalar or broken JSON give null. For a
    struct: a struct whose fields are all null (an empty object) gives null.
    """
    if isinstance(dtype, StructType):
        present = [_c(c).getField(f.name).isNotNull() for f in dtype.fields]
        any_present = present[0]
        for p in present[1:]:
            any_present = any_present | p
        return F.when(any_present, _c(c))
    if isinstance(dtype, VariantType):
        kind = F.schema_of_variant(_c(c))
        return F.when(kind.startswith("OBJECT") & (F.to_json(_c(c)) != "{}"), _c(c))
    keys = F.map_keys(F.from_json(_c(c), "map<string,string>"))
    return F.when(F.size(keys) > 0, _c(c))
