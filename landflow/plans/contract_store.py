"""Stored contracts: what each run showed of a family's items, merged over runs.

A run's sketch is the inferred type of the items of its complete chains, one small
row of DDL text. It is inferred once: a later job that finds the run's sketch
reads no body for it. The contract is the merge of all sketches of a family, so a
key that a run happens not to hold keeps its column and its type.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, NullType, StringType, StructField, StructType, VariantType

from landflow.operators.aggregates import infer_item_schema
from landflow.sinks.tables import save_tables
from landflow.sources.pages import Dialect, IncompleteChain, chain_status, page_columns, usable_items
from landflow.sources.runs import MissingRun

STORE = "landing_contracts"
_SCHEMA = "family string, run_id string, pages long, ddl string"


def sketch_from_inferred(ddl: str) -> StructType:
    """The inferred variant type of the items as a Spark struct: objects become
    structs, keys that only held null stay void, and decimals, whose inferred
    size follows the values of one run, become double. Only types are rewritten:
    a type follows ``: `` or ``ARRAY<``, and quoted keys are left alone."""
    parts = re.split(r"(`(?:[^`]|``)*`)", ddl)
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"(?:(?<=: )|(?<=ARRAY<)|^(?=OBJECT<))(OBJECT<|DECIMAL\(\d+, *\d+\))",
                          lambda m: "STRUCT<" if m[1] == "OBJECT<" else "DOUBLE", parts[i])
    text = "".join(parts)
    if text == "VOID":  # no items
        return StructType([])
    if not text.startswith("STRUCT<"):
        raise ValueError(f"items are not objects: {ddl}")
    return StructType.fromDDL(text[len("STRUCT<"):-1])


def merged(a: DataType, b: DataType) -> DataType:
    """The type that holds both: void gives way, structs and lists merge by part,
    bigint and double meet as double, a variant takes all; values of other types
    that differ are kept as text. The order of merging does not matter, but for
    the order of keys, which are those of ``a``, then the new ones of ``b``."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, VariantType) or isinstance(b, VariantType):
        return VariantType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        have = {f.name: f for f in a.fields}
        other = {f.name: f.dataType for f in b.fields}
        fields = [StructField(n, merged(f.dataType, other.get(n, NullType()))) for n, f in have.items()]
        return StructType(fields + [StructField(n, t) for n, t in other.items() if n not in have])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merged(a.elementType, b.elementType))
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    return StringType()


def declared_types(t: DataType) -> DataType:
    """A merged sketch as a contract: what only ever held null is text."""
    if isinstance(t, NullType):
        return StringType()
    if isinstance(t, StructType):
        return StructType([StructField(f.name, declared_types(f.dataType)) for f in t.fields])
    return ArrayType(declared_types(t.elementType)) if isinstance(t, ArrayType) else t


def type_paths(t: DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, type) of the leaves; ``[]`` marks the elements of a list."""
    if isinstance(t, StructType):
        return [p for f in t.fields for p in type_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(t, ArrayType):
        return type_paths(t.elementType, f"{path}[]")
    return [(path, t.simpleString())]


class Contracts:
    """The contracts of a job, kept in ``<schema>.landing_contracts``.

    ``of`` gives a family's contract, ``save`` stores the sketches that were
    inferred for it; a job calls it after its tables are stored. The store has one
    row per family and run (a handful of short texts), the only rows that are
    read to the driver.
    """

    def __init__(self, spark: SparkSession, schema: str) -> None:
        self.spark, self.schema, self.table = spark, schema, f"{schema}.{STORE}"
        self.new: list[tuple[str, str | None, int, str]] = []
        self.rows = []
        if spark.catalog.tableExists(self.table):
            self.rows = [tuple(r) for r in spark.read.table(self.table).select("family", "run_id", "pages", "ddl").collect()]

    def of(self, family: str, pages: DataFrame, dialect: Dialect, run: str | None,
           declared: StructType | str | None = None) -> StructType:
        """The declared contract, or the merge of the family's sketches.

        ``pages`` are those of ``run``. Its sketch is taken from the store if it was
        made from as many pages; a landing without runs has no name to keep one
        under that a later landing would not share, so it is inferred anew.
        """
        if declared is not None:
            return declared if isinstance(declared, StructType) else StructType.fromDDL(declared)
        n = pages.count()
        old = [(r, k, d) for f, r, k, d in self.rows if f == family and not (r == run and run is not None and k != n)]
        known = run is not None and any(r == run for r, _, _ in old)
        sketches = [_struct(d) for _, _, d in old]
        if not known:
            items = usable_items(pages.select(*page_columns(pages)), dialect)
            seen = sketch_from_inferred(infer_item_schema(items))
            self.new.append((family, run, n, _ddl(seen)))
            sketches.append(seen)
        out = StructType([])
        for s in sketches:
            out = merged(out, s)
        if not out.fields:
            if n == 0:
                raise MissingRun(f"run {run} landed nothing of {family}, and no contract is stored")
            if not chain_status(pages, dialect).where("not complete").isEmpty():
                raise IncompleteChain(f"no complete request of {family}, and no contract is stored")
            raise ValueError(f"{family} has no items to infer a contract from, and none is stored")
        return declared_types(out)

    def save(self) -> None:
        """Store the new sketches, one row per family and run; landings without runs
        share a row, which holds the merge of what they showed."""
        if not self.new:
            return
        kept = {(f, r): (f, r, k, d) for f, r, k, d in self.rows}
        for f, r, k, d in self.new:
            before = kept.get((f, r))
            if before and r is None:
                d = _ddl(merged(_struct(before[3]), _struct(d)))
            kept[(f, r)] = (f, r, k, d)
        rows = self.spark.createDataFrame(sorted(kept.values(), key=lambda x: (x[0], x[1] or "")), _SCHEMA).coalesce(1)
        save_tables({STORE: rows}, self.schema, policy="skip", schema_mode="replace")
        self.rows, self.new = list(kept.values()), []


def _ddl(t: StructType) -> str:
    """DDL text that ``StructType.fromDDL`` reads back, whatever the keys."""
    def text(d: DataType) -> str:
        if isinstance(d, StructType):
            return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{text(f.dataType)}" for f in d.fields) + ">"
        return f"array<{text(d.elementType)}>" if isinstance(d, ArrayType) else d.simpleString()

    return text(t)[len("struct<"):-1]


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl) if ddl else StructType([])
