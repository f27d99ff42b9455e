"""Row filters. Plain ``where`` on columns, so Parquet scans get them as
``PushedFilters`` and partitioned tables as ``PartitionFilters``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# FL1 ----------------------------------------------------------------------
def where_active(df: DataFrame, type_col: str = "type", state_col: str = "state",
                 type_value: str = "Workspace", state_value: str = "Active") -> DataFrame:
    """Rows of the given type in the given state (the source's
    ``type eq 'Workspace' and state eq 'Active'``)."""
    return df.where((F.col(type_col) == type_value) & (F.col(state_col) == state_value))


# FL2 ----------------------------------------------------------------------
def where_day(df: DataFrame, ts_col: str, day: str) -> DataFrame:
    """One day, half-open: ``day <= ts < day + 1``. Unlike an end bound of
    23:59:59.000 this keeps events in the last second's fraction."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    ts = F.col(ts_col)
    return df.where((ts >= start) & (ts < end))


# FL3 ----------------------------------------------------------------------
def where_key_present(df: DataFrame, col: str) -> DataFrame:
    """Parents with a usable id: not null and not empty text."""
    c = F.col(col)
    return df.where(c.isNotNull() & (c.cast("string") != ""))


# FL6 ----------------------------------------------------------------------
def choose(specs: dict[str, object], include: dict[str, bool]) -> dict[str, object]:
    """Keep the table specs whose flag is on (or that have no flag). Specs
    that are not chosen are never built, so their plans never run."""
    return {name: spec for name, spec in specs.items() if include.get(name, True)}
