"""Landed response pages: read, unnest, cut at the terminal page, audit.

A landed page is one line ``(request_key, page_no, status, raw)``: the key of
the request chain, the page's position in it, the HTTP status and the response
body as JSON text. One page per line keeps files splittable.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from landflow.operators.aggregates import running_total
from landflow.session import bounded_broadcast, dealt

PAGE_SCHEMA = StructType(
    [
        StructField("request_key", StringType()),
        StructField("page_no", LongType()),
        StructField("status", IntegerType()),
        StructField("raw", StringType()),
    ]
)


@dataclass(frozen=True)
class Dialect:
    """Envelope shape of one API family."""

    payload: str
    link: str | None = None
    last: str | None = None
    single_page: bool = False


# The envelope key names each API family uses.
ODATA = Dialect(payload="value", link="@odata.nextLink")
ACTIVITY = Dialect(payload="activityEventEntities", link="continuationUri", last="lastResultSet")
SETTINGS = Dialect(payload="tenantSettings", single_page=True)
DIALECTS = {"odata": ODATA, "activity": ACTIVITY, "settings": SETTINGS}


def _dialect(d: Dialect | str) -> Dialect:
    """A dialect, a dialect name, or a bare payload key (no continuation)."""
    if isinstance(d, Dialect):
        return d
    return DIALECTS.get(d) or Dialect(payload=d)


def _path(key: str) -> str:
    return f'$["{key}"]'


# SC1 ----------------------------------------------------------------------
CORRUPT = "_corrupt"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON lines, the text of those that can't be read, and their file."""
    schema = StructType([*PAGE_SCHEMA.fields, StructField(CORRUPT, StringType())])
    # partition columns of the folder (a run, a day) come after the schema's own
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return lines.select("*", F.col("_metadata.file_path").alias("_file"))


def _malformed() -> Column:
    """A line that is no page: not JSON, a field of another type, no key, or
    neither status nor body. All fields are named: a scan that leaves a field out
    would not notice its type."""
    nothing = F.col("status").isNull() & F.col("raw").isNull()
    return F.col(CORRUPT).isNotNull() | F.col("request_key").isNull() | F.col("page_no").isNull() | nothing


def read_pages(spark: SparkSession, path: str, fmt: str = "json", malformed: str = "stop") -> DataFrame:
    """Read landed pages. JSON lines as landed, or Parquet after compaction
    (Parquet lets the key columns be read without touching ``raw``).

    A malformed line may be any page of any request: it ends whatever reads the
    pages (``stop``, tested in the same scan), or is left to
    ``malformed_lines`` (``skip``)."""
    if malformed not in ("stop", "skip"):
        raise ValueError(f"unknown choice {malformed!r}")
    if fmt != "json":
        return spark.read.format(fmt).load(path)  # keeps envelope columns if landed
    lines = _lines(spark, path)
    if malformed == "skip":
        kept = lines.where(~_malformed())
    else:
        told = F.raise_error(F.concat(F.lit("malformed page line in "), F.col("_file"), F.lit(": "), F.substring(F.coalesce(CORRUPT, F.lit("no key")), 1, 200)))
        kept = lines.where(F.when(_malformed(), told.cast("boolean")).otherwise(F.lit(True)))
    return kept.drop(CORRUPT, "_file")


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, text, reason)`` of the lines that are no pages, for the
    quarantine; a line without a key keeps its fields as JSON text."""
    bad = _lines(spark, path).where(_malformed())
    names = [f.name for f in PAGE_SCHEMA.fields]
    return bad.select(F.col("_file").alias("file"), F.coalesce(CORRUPT, F.to_json(F.struct(*names))).alias("text"),
                      F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed line"))
                       .when(F.col("request_key").isNull() | F.col("page_no").isNull(), F.lit("no key")).otherwise(F.lit("no answer")).alias("reason"))


ENVELOPE_COLUMNS = ("terminal", "valid")
#: Items of a page, where the landing counted them.
COUNT_COLUMN = "n_items"
#: Partition columns of a landing that holds several runs or days.
LANDING_COLUMNS = ("run_id", "day")


def page_columns(pages: DataFrame) -> list[str]:
    """The page columns the pipelines read, with the landed envelope facts
    when the landing recorded them."""
    base = [f.name for f in PAGE_SCHEMA.fields]
    return base + [c for c in (*ENVELOPE_COLUMNS, *LANDING_COLUMNS) if c in pages.columns]


def write_pages(pages: DataFrame, path: str, fmt: str = "json", dialect: Dialect | str | None = None,
                count_items: bool = False) -> None:
    """Land pages (the inverse of ``read_pages``). With ``dialect`` (columnar
    formats) the envelope facts are stored as columns ``terminal`` and
    ``valid``, so the chain status never has to read the bodies again;
    ``count_items`` stores ``n_items`` too, for ``page_audit``."""
    cols = [F.col(f.name) for f in PAGE_SCHEMA.fields]
    if count_items and dialect is None:
        raise ValueError("items are counted under a dialect")
    if dialect is not None:
        env = light_envelope(F.col("raw"), dialect)
        cols += [env["terminal"].alias("terminal"), env["valid"].alias("valid")]
    if count_items:
        cols.append(item_count(F.col("raw"), dialect).alias(COUNT_COLUMN))
    pages.select(*cols).write.mode("overwrite").format(fmt).save(path)


# envelope -----------------------------------------------------------------
def _doc(raw: Column) -> Column:
    return F.try_parse_json(raw)


def envelope_columns(doc: Column, dialect: Dialect | str) -> dict[str, Column]:
    """Per-page facts read from the parsed body: payload kind, item count,
    continuation link, last-set flag and whether the chain ends here."""
    d = _dialect(dialect)
    payload = F.try_variant_get(doc, _path(d.payload), "variant")
    kind = F.schema_of_variant(payload)
    is_list = kind.startswith("ARRAY")
    is_object = kind.startswith("OBJECT")
    n_items = (
        F.when(is_list, F.size(F.try_variant_get(payload, "$", "array<variant>")))
        .when(is_object, F.lit(1))
        .otherwise(F.lit(0))
    )
    link = F.try_variant_get(doc, _path(d.link), "string") if d.link else F.lit(None).cast("string")
    last = (
        F.coalesce(F.try_variant_get(doc, _path(d.last), "boolean"), F.lit(False))
        if d.last
        else F.lit(False)
    )
    if d.single_page:
        terminal = F.lit(True)
    else:
        # the chain ends at a last-set flag, at a missing link, or after a
        # payload that is one object instead of a list
        terminal = last | link.isNull() | (link == "") | is_object
    return {
        "payload": payload,
        "payload_kind": kind,
        "n_items": n_items.cast("long"),
        "next_link": link,
        "is_last": last,
        "terminal": terminal,
    }


def page_envelope(pages: DataFrame, dialect: Dialect | str) -> DataFrame:
    """``(request_key, page_no, status, parsed, n_items, next_link, is_last,
    terminal)`` per page; the body is parsed once."""
    doc = _doc(F.col("raw"))
    cols = envelope_columns(F.col("_doc"), dialect)
    return (
        pages.select("request_key", "page_no", "status", doc.alias("_doc"))
        .select(
            "request_key",
            "page_no",
            "status",
            F.col("_doc").isNotNull().alias("parsed"),
            cols["n_items"].alias("n_items"),
            cols["next_link"].alias("next_link"),
            cols["is_last"].alias("is_last"),
            cols["terminal"].alias("terminal"),
        )
    )


# SC2 ----------------------------------------------------------------------
def _texts(raw: Column, dialect: Dialect | str) -> Column:
    """The payload's elements as JSON text, split by one streaming ``from_json``; a
    lone object is taken whole, anything else has none (null)."""
    key = _dialect(dialect).payload
    as_list = F.from_json(raw, StructType([StructField(key, ArrayType(StringType()))])).getField(key)
    probe = F.from_json(raw, StructType([StructField(key, StructType([]))])).getField(key)
    lone = F.array(F.get_json_object(raw, f"$['{key}']"))
    return F.when(as_list.isNotNull(), as_list).when(probe.isNotNull(), lone)


def item_count(raw: Column, dialect: Dialect | str) -> Column:
    """Items of a page without a parse tree: elements of a list payload, 1 for
    a lone object, else 0."""
    return F.coalesce(F.size(_texts(raw, dialect)), F.lit(0)).cast("long")


def _unfit(doc: Column, raw: Column) -> Column:
    """A body that is JSON but too large (or otherwise unfit) for a VARIANT."""
    return doc.isNull() & body_ok(raw)


def _alone(text: Column) -> Column:
    """An item parsed from its own text, null if no VARIANT holds it. The split
    takes the quotes off a plain string, so one that reads as JSON is taken so."""
    plain = text.cast("variant")
    return F.coalesce(_doc(text), F.when(text.isNull(), F.parse_json(F.lit("null"))).when(~text.rlike(r"^[{\[]"), plain))


def unfit_items(pages: DataFrame, dialect: Dialect | str) -> DataFrame:
    """``(request_key, page_no, position, item_text, reason)`` of the items that
    can't be held as VARIANT, for the quarantine; ``position`` is the item's place
    in its page, from 0."""
    d = pages.select("request_key", "page_no", "raw", _doc(F.col("raw")).alias("_doc"))
    d = d.where(_unfit(F.col("_doc"), F.col("raw")))
    items = d.select("request_key", "page_no", F.posexplode(_texts(F.col("raw"), dialect)).alias("position", "item_text"))
    return items.where(_alone(F.col("item_text")).isNull()).select("*", F.lit("item can't be held as VARIANT").alias("reason"))


def unnest_pages(
    pages: DataFrame, dialect: Dialect | str, keep: tuple[str, ...] = (), with_terminal: bool = False,
    unfit: str = "stop",
) -> DataFrame:
    """One row per payload item: ``(request_key, page_no, item VARIANT)``.

    A body that a VARIANT can't hold as a whole (over its size limit, say) is split
    into its items' texts and each is parsed alone. An item that can't be held
    either ends the job (``stop``) or is left to ``unfit_items`` (``skip``).

    A list payload gives one row per element, a lone object gives one row, a
    missing or null payload gives none. ``with_terminal`` also keeps pages
    that have no items (item null) together with their ``terminal`` flag so
    that ``keep_until_terminal`` can run on the items in the same pass.
    """
    if unfit not in ("stop", "skip"):
        raise ValueError(f"unknown choice {unfit!r}")
    env = envelope_columns(F.col("_doc"), dialect)
    payload = env["payload"]
    kind = env["payload_kind"]
    split = _unfit(F.col("_doc"), F.col("raw"))

    def alone(text: Column) -> Column:
        if unfit == "skip":
            return _alone(text)
        return F.coalesce(_alone(text), F.raise_error(F.concat(F.lit("page item can't be held as VARIANT: "), F.col("request_key"))).cast("variant"))

    texts = F.transform(_texts(F.col("raw"), dialect), alone)
    items = (
        F.when(split, F.filter(texts, lambda x: x.isNotNull()) if unfit == "skip" else texts)
        .when(kind.startswith("ARRAY"), F.try_variant_get(payload, "$", "array<variant>"))
        .when(kind.startswith("OBJECT"), F.array(payload))
    )
    base = pages.select("request_key", "page_no", *keep, "raw", _doc(F.col("raw")).alias("_doc"))
    if with_terminal:
        end = F.when(split, light_envelope(F.col("raw"), dialect)["terminal"]).otherwise(env["terminal"])
        return base.select(
            "request_key", "page_no", *keep,
            end.alias("terminal"),
            F.explode_outer(items).alias("item"),
        )
    return base.select("request_key", "page_no", *keep, F.explode(items).alias("item"))


def unnest_texts(pages: DataFrame, dialect: Dialect | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Like ``unnest_pages`` but each item stays JSON text (``item_text``),
    with its keys in the record's own order: the payload is split by one
    streaming ``from_json`` into text elements; a lone object is taken
    whole."""
    return pages.select("request_key", "page_no", *keep, F.explode(_texts(F.col("raw"), dialect)).alias("item_text"))


def items_as(df: DataFrame, schema: StructType | str, item_col: str = "item", drop: bool = True) -> DataFrame:
    """Project variant items onto a declared struct: missing keys and values
    of the wrong type become null, extra keys are ignored, nested objects in
    string fields keep their JSON text."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    typed = F.try_variant_get(F.col(item_col), "$", struct.simpleString()).alias("_typed")
    rest = [c for c in df.columns if not (drop and c == item_col)]
    # a column already on the row (a parent key taken from the request)
    # wins over an item field of the same name
    fields = [F.col("_typed").getField(f.name).alias(f.name) for f in struct.fields if f.name not in rest]
    return df.select(*rest, typed).select(*rest, *fields)


# SC3 ----------------------------------------------------------------------
def keep_until_terminal(df: DataFrame, flag_col: str = "terminal", key: str = "request_key",
                        order: str = "page_no") -> DataFrame:
    """Drop pages after the first terminal page of each chain.

    Works on pages or on items carrying their page's flag. The cut is one row
    per chain from a partial (map-side) aggregate; it is checked for size and
    broadcast, so the page bodies themselves are never shuffled.
    """
    cut = (
        df.where(F.col(flag_col))
        .groupBy(key)
        .agg(F.min(order).alias("_cut"))
    )
    cut = bounded_broadcast(cut)
    return (
        df.join(cut, key, "left")
        .where(F.col("_cut").isNull() | (F.col(order) <= F.col("_cut")))
        .drop("_cut")
    )


def light_envelope(raw: Column, dialect: Dialect | str) -> dict[str, Column]:
    """Envelope facts without building the body: one streaming ``from_json``
    of the envelope keys (the payload probed as an empty struct, which is
    non-null only for an object) and a streaming validity check. About five
    times cheaper than a full parse on large pages."""
    d = _dialect(dialect)
    fields = [StructField(d.payload, StructType([]))]
    if d.link:
        fields.append(StructField(d.link, StringType()))
    if d.last:
        fields.append(StructField(d.last, BooleanType()))
    env = F.from_json(raw, StructType(fields))
    is_object = env.getField(d.payload).isNotNull()
    link = env.getField(d.link) if d.link else F.lit(None).cast("string")
    last = F.coalesce(env.getField(d.last), F.lit(False)) if d.last else F.lit(False)
    if d.single_page:
        terminal = F.lit(True)
    else:
        terminal = last | link.isNull() | (link == "") | is_object
    return {"valid": body_ok(raw), "terminal": terminal}


#: Places of a chain that are grouped together.
CHAIN_BLOCK = 1024


class IncompleteChain(RuntimeError):
    """Raised where a job must not load from a failed or unfinished chain."""


def chain_keys(pages: DataFrame) -> list[str]:
    """What names one fetched chain: the request and, where landed, its run."""
    return ["request_key", *(["run_id"] if "run_id" in pages.columns else [])]


def run_order(run_id: Column | str) -> Column:
    """A sort key of run ids: by time where they are times, by size where they are
    numbers (run 10 is after run 9), else by text. Null sorts first."""
    text = (F.col(run_id) if isinstance(run_id, str) else run_id).cast("string")
    return F.struct(F.try_to_timestamp(text).alias("at"), text.try_cast("decimal(38,0)").alias("number"), text.alias("text"))


def chain_status(pages: DataFrame, dialect: Dialect | str, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per fetched chain: ``(request_key[, run_id], failed, cut, complete)``;
    columns of ``by`` name a chain too.

    ``failed``: some page has a non-2xx status or a body that is not a JSON
    object. ``cut``: the first terminal page, null when the chain never ends.
    ``complete``: not failed, and pages 0 to ``cut`` are all there, once each.

    Every page also marks the place after its own, so the first place that is
    marked but has no page is the first gap. The aggregates work on narrow rows,
    those by place on blocks of places, so a long chain is spread; the tasks grow
    in number with the pages (counted first), not in memory.
    """
    if all(c in pages.columns for c in ENVELOPE_COLUMNS):
        # facts recorded at landing: a column read, the bodies stay untouched
        valid, terminal = F.col("valid"), F.col("terminal")
    else:
        env = light_envelope(F.col("raw"), dialect)
        valid, terminal = env["valid"], env["terminal"]
    keys = [*chain_keys(pages), *by]
    bad = ~(F.coalesce(F.col("status").between(200, 299), F.lit(False)) & F.coalesce(valid, F.lit(False)))
    facts = pages.select(*keys, "page_no", bad.alias("bad"), F.coalesce(terminal, F.lit(False)).alias("end"))
    places = facts.select(*keys, F.inline(F.array(
        F.struct(F.col("page_no").alias("place"), F.lit(1).alias("n"), "bad", "end"),
        F.struct((F.col("page_no") + 1).alias("place"), F.lit(0).alias("n"), F.lit(False).alias("bad"), F.lit(False).alias("end")))))
    rows = pages.count()
    places = dealt(places.withColumn("_blk", F.floor(F.col("place") / CHAIN_BLOCK)), 2 * rows, *keys, "_blk")
    places = places.groupBy(*keys, "_blk", "place").agg(F.sum("n").alias("n"), F.max("bad").alias("bad"), F.max("end").alias("end"))
    blocks = places.groupBy(*keys, "_blk").agg(
        F.max("bad").alias("failed"),
        F.min(F.when(F.col("end"), F.col("place"))).alias("cut"),
        F.min("place").alias("_first"),
        F.min(F.when(F.col("n") != 1, F.col("place"))).alias("_odd"),
    )
    # by request: the runs of one are compared next
    chains = dealt(blocks, 2 * rows, "request_key").groupBy(*keys).agg(
        F.max("failed").alias("failed"), F.min("cut").alias("cut"), F.min("_first").alias("_first"), F.min("_odd").alias("_odd"))
    whole = ~F.col("failed") & F.col("cut").isNotNull() & (F.col("_first") == 0) & (F.col("_odd") > F.col("cut"))
    return chains.select(*keys, "failed", "cut", F.coalesce(whole, F.lit(False)).alias("complete"))


def chain_items(pages: DataFrame, dialect: Dialect | str, chains: DataFrame, keep: tuple[str, ...] = (),
                as_text: bool = False) -> DataFrame:
    """Items of the pages that ``chains`` (chain keys and ``cut``) names, up to
    each chain's cut. The pages are cut before their bodies are unnested."""
    keys = [c for c in chains.columns if c != "cut"]
    kept = pages.join(chains, keys).where(F.col("page_no") <= F.col("cut")).drop("cut")
    return (unnest_texts if as_text else unnest_pages)(kept, dialect, keep=keep)


def usable_items(pages: DataFrame, dialect: Dialect | str, keep: tuple[str, ...] = (),
                 on_incomplete: str = "skip", as_text: bool = False) -> DataFrame:
    """Items of complete chains, up to each chain's terminal page; of a request
    landed by several runs, those of the latest complete run (jobs read one run:
    ``runs.snapshot``).

    A request without a complete chain is left out (``skip``) or ends the job
    (``stop``): part of a chain never replaces stored data. The pages are cut
    before their bodies are unnested; the size-checked chain table is broadcast,
    so the bodies are not shuffled; beyond that size both are dealt to tasks by
    the rows of the pages.
    """
    if on_incomplete not in ("skip", "stop"):
        raise ValueError(f"unknown choice {on_incomplete!r}")
    keys = chain_keys(pages)
    status = chain_status(pages, dialect)
    if len(keys) > 1:
        best = F.max(F.when(F.col("complete"), F.struct(run_order("run_id").alias("o"), "run_id", "cut")))
        status = status.groupBy("request_key").agg(best.alias("best")).select(
            "request_key", "best.run_id", "best.cut", F.col("best").isNotNull().alias("complete"))
    told = status.select(*keys, "cut", "complete")
    status = bounded_broadcast(told)
    wide = status is told
    if on_incomplete == "stop":
        lost = status.where(~F.col("complete")).select("request_key").take(3)
        if lost:
            raise IncompleteChain(f"failed, unfinished or gapped requests, nothing loaded: {[r[0] for r in lost]}")
    chains = status.where("complete").drop("complete")
    if wide:
        rows = pages.count()
        pages, chains = dealt(pages, rows, *keys), dealt(chains, rows, *keys)
    return chain_items(pages, dialect, chains, keep, as_text)


def incomplete_chains(pages: DataFrame, dialect: Dialect | str) -> DataFrame:
    """Chains without a failed page that are unfinished, gapped or landed
    twice: ``(request_key, reason)``, for the quarantine."""
    lost = chain_status(pages, dialect).where(~F.col("complete") & ~F.col("failed"))
    return lost.select("request_key", F.lit("incomplete chain").alias("reason"))


# SC4 ----------------------------------------------------------------------
def scan_keys(spark: SparkSession, table: str, col: str) -> DataFrame:
    """One key column of a stored table (the scan reads only that column)."""
    return spark.read.table(table).select(col)


# FL5 ----------------------------------------------------------------------
def body_ok(raw: Column) -> Column:
    """The body is a well-formed JSON object (streaming check, the same test
    ``chain_status`` applies)."""
    return F.json_object_keys(raw).isNotNull()


def page_ok(status: Column | str = "status", raw: Column | str = "raw") -> Column:
    s = F.col(status) if isinstance(status, str) else status
    r = F.col(raw) if isinstance(raw, str) else raw
    return s.between(200, 299) & body_ok(r)


def split_failed(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): a page fails on a non-2xx status or a body that is
    not a JSON object. The quarantine keeps the failure reason as data."""
    ok = page_ok()
    reason = (
        F.when(~F.col("status").between(200, 299), F.concat(F.lit("status "), F.col("status").cast("string")))
        .when(~body_ok(F.col("raw")), F.lit("unparseable body"))
    )
    good = pages.where(ok)
    bad = pages.where(~ok | ok.isNull()).withColumn("reason", reason)
    return good, bad


def without_failed_chains(pages: DataFrame, key: str = "request_key") -> DataFrame:
    """Pages of chains in which no page failed (a partial chain is not
    loaded, so a failed fetch never replaces good stored data)."""
    _, bad = split_failed(pages)
    bad_keys = bounded_broadcast(bad.select(key).distinct())
    return pages.join(bad_keys, key, "left_anti")


# WN1 ----------------------------------------------------------------------
def page_audit(pages: DataFrame, dialect: Dialect | str) -> DataFrame:
    """Items per page and the running total of items along each chain. Counts come
    from the landing where it stored them, and no body is read; else from a
    streaming split of the payload."""
    count = F.col(COUNT_COLUMN) if COUNT_COLUMN in pages.columns else item_count(F.col("raw"), dialect)
    counted = pages.select("request_key", "page_no", count.alias("n_items"))
    return running_total(counted, "request_key", "page_no", "n_items", "items_so_far")


# SO1 ----------------------------------------------------------------------
def union_pages(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# landing ------------------------------------------------------------------
def pack_pages(
    items: DataFrame,
    request_key: Column,
    page_no: Column,
    item: Column,
    dialect: Dialect | str,
    is_last: Column | None = None,
    status: Column | None = None,
    object_when_single: bool = False,
    renumber: bool = False,
    places: DataFrame | None = None,
) -> DataFrame:
    """Build landed pages from rows (the inverse of ``unnest_pages``).

    ``page_no`` must bound the items per page (for example a key divided by a
    page size) so no page collects an unbounded group. The continuation link
    is omitted on a chain's last page: ``is_last`` (an expression over the
    item rows, evaluated per page with ``max``) says which page that is.
    ``renumber`` numbers each chain's pages from 0 without gaps and ends it at
    its last one, in one window per chain: for chains of few pages, whose items
    are dealt by chain. ``places`` (``request_key, page_no, _no, _closes``) gives
    the pages' numbers and ends instead; it is joined to whole pages.
    """
    d = _dialect(dialect)
    last_expr = F.max(is_last) if is_last is not None else F.lit(False)
    if renumber:
        rows = items.count()
        items = dealt(items.withColumns({"_rk": request_key, "_pn": page_no.cast("long")}), rows, "_rk")
        request_key, page_no = F.col("_rk"), F.col("_pn")
    grouped = (
        items.groupBy(request_key.alias("request_key"), page_no.cast("long").alias("page_no"))
        .agg(
            F.collect_list(item).alias("_items"),
            last_expr.alias("_last"),
            (F.max(status) if status is not None else F.lit(200)).alias("status"),
        )
    )
    if renumber:
        chain = Window.partitionBy("request_key").orderBy("page_no")
        grouped = grouped.withColumns({"page_no": F.row_number().over(chain).cast("long") - 1, "_last": F.lead("page_no").over(chain).isNull()})
    if places is not None:
        grouped = grouped.drop("_last").join(places, ["request_key", "page_no"]).withColumns(
            {"page_no": F.col("_no"), "_last": F.col("_closes")})
    payload = F.col("_items")
    if object_when_single:
        payload = F.when(F.size("_items") == 1, F.to_json(F.col("_items")[0])).otherwise(F.to_json(payload))
    else:
        payload = F.to_json(payload)
    parts = [F.lit(f'{{"{d.payload}":'), payload]
    if d.link:
        link = F.concat(F.lit("/"), F.col("request_key"), F.lit("?page="), (F.col("page_no") + 1).cast("string"))
        parts += [F.when(~F.col("_last"), F.concat(F.lit(f',"{d.link}":"'), link, F.lit('"'))).otherwise(F.lit(""))]
    if d.last:
        parts += [F.lit(f',"{d.last}":'), F.when(F.col("_last"), F.lit("true")).otherwise(F.lit("false"))]
    parts += [F.lit("}")]
    return grouped.select(
        "request_key", "page_no", F.col("status").cast("int").alias("status"), F.concat(*parts).alias("raw")
    )
