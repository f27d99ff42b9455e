"""WARC archives: a writer of response and revisit records, and a Python data
source that reads them.

The reader plans one partition per file, takes equality predicates on the
record type and on headers, parses a record's headers first and skips the block
of a record that the predicates reject, or whose payload isn't asked for, by a
seek. Spark hands predicates to Python sources only where
``spark.sql.python.filterPushdown.enabled`` is set; elsewhere it filters the rows
itself.

A folder of archives has a manifest, which Spark commits: an archive that a lost or
repeated task left behind isn't in it and isn't read. Without one, every archive of
the folder is read.

Cases: a null html is an empty payload, a null url has no target header, and
control characters and non-ASCII letters of a url are percent-encoded; pages of
equal payload are revisits of the one with the largest page_id; of rows that
repeat that page_id are responses each; a null page_id counts as the
smallest; an empty table makes no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition
from pyspark.sql.types import LongType, StringType

from landflow.llm.files import listed, opened, put
from landflow.session import bounded_broadcast, materialize, scratch_path

#: Bytes after which a task begins another archive.
FILE_BYTES = 32 << 20
#: A payload of fewer bytes is never a revisit.
LEAST_BYTES = 0
VERSION = b"WARC/1.1"
MANIFEST = "manifest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool) -> bytes:
    """One record: an HTTP message as its block, without the body in a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(original)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(stream, wanted=lambda head: True, payloads: bool = True) -> Iterator[tuple[dict[str, str], dict[str, str], bytes | None]]:
    """(headers, HTTP headers, payload) of each wanted record of an open archive."""
    at = 0
    while True:
        stream.seek(at)
        data = b""
        while b"\r\n\r\n" not in data:
            more = stream.read(1024)
            if not more:
                if data:
                    raise ValueError(f"an archive ends within a record's headers, at byte {at}")
                return
            data += more
        end = data.index(b"\r\n\r\n")
        lines = data[:end].decode("utf-8").split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"not a record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, size = at + end + 4, int(head["content-length"])
        at = start + size + 4
        if not wanted(head):
            continue
        stream.seek(start)
        block = stream.read(size if payloads else min(size, 4096))
        top, _, body = block.partition(b"\r\n\r\n")
        http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in top.decode("latin-1").split("\r\n")[1:])}
        yield head, http, body if payloads else None


class _File(InputPartition):
    def __init__(self, uri: str) -> None:
        self.uri = uri


class _Reader(DataSourceReader):
    HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
               "digest": "warc-payload-digest", "refers_to": "warc-refers-to"}

    def __init__(self, options: dict) -> None:
        self.folder, self.equal = options["path"], []
        self.payloads = options.get("payloads", "true").lower() == "true"

    def partitions(self):
        committed = listed(f"{self.folder.rstrip('/')}/{MANIFEST}", ".parquet")
        if not committed:
            return [_File(uri) for uri, _ in listed(self.folder, ".warc")]
        return [_File(uri) for uri in sorted(p for part, _ in committed for p in _paths(part))]

    def read(self, partition):
        if not isinstance(partition, _File):  # an empty folder
            return
        with opened(partition.uri) as stream:
            for head, http, body in records(stream, lambda h: all(h.get(k) == v for k, v in self.equal), self.payloads):
                yield (head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"),
                       head.get("warc-payload-digest"), head.get("warc-refers-to"), int(http.get("content-length", 0)), body)


class _PushingReader(_Reader):
    """Takes predicates; Spark refuses such a reader where it hands over none."""

    def pushFilters(self, filters):  # noqa: N802 - the data source's interface
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in self.HEADERS:
                self.equal.append((self.HEADERS[f.attribute[0]], f.value))
            else:
                yield f


def _paths(part: str) -> list[str]:
    import pyarrow.parquet as pq

    with opened(part) as f:
        return pq.read_table(f, columns=["path"])["path"].to_pylist()


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payloads", "false").load(folder)``;
    ``option("pushdown", "true")`` where the session hands over predicates."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ("record_type string, record_id string, target_uri string, digest string, refers_to string, "
                "http_length long, payload binary")

    def reader(self, schema) -> DataSourceReader:
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return (_PushingReader if pushing else _Reader)(self.options)


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives and their manifest; a row (path, records) for each."""
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(body).alias("sha"), F.length(body).alias("n"))
    first = rows.where(F.col("n") >= least).groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("times"))
    # a digest that occurs once needs no mate: only the rest is looked up
    # (broadcast within the session's checked bound, so that html stays in place)
    twice = bounded_broadcast(first.where(F.col("times") > 1).select(F.col("sha").alias("s"), "first"))
    known = rows.join(twice, (F.col("sha") == F.col("s")) & (F.col("n") >= least), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an attempt's own names: one that was given up can't replace a committed archive
        task = TaskContext.get()
        part, made, count, data = f"{task.partitionId():06d}-{task.taskAttemptId()}", 0, 0, bytearray()

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/part-{part}-{made:06d}.warc"
            put(uri, bytes(data))
            return pa.record_batch([pa.array([uri]), pa.array([count], pa.int64())], ["path", "records"])

        for batch in batches:
            for page, url, html, s, original in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "s", "first"))):
                payload = (html or "").encode("utf-8")
                again = s is not None and page != original
                data += record(page, url, payload, digest_of(payload), original, again)
                count += 1
                if len(data) >= file_bytes:
                    yield flush()
                    made, count, data = made + 1, 0, bytearray()
        if count:
            yield flush()

    made = known.select("page_id", "url", "html", "s", "first").mapInArrow(run, "path string, records long")
    made.write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")
    return pages.sparkSession.read.parquet(f"{folder}/{MANIFEST}")


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_archives(spark, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a folder of archives. Run the result under the same setting
    of ``PUSHDOWN`` (see ``pushdown``) that it was made under."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").options(payloads=str(payloads).lower(), pushdown=spark.conf.get(PUSHDOWN, "false")).load(folder)


@contextmanager
def pushdown(spark):
    """Predicates go to Python sources within it; the session's setting comes back."""
    before = spark.conf.get(PUSHDOWN, None)
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        spark.conf.unset(PUSHDOWN) if before is None else spark.conf.set(PUSHDOWN, before)


@F.pandas_udf(LongType())
def _page(ids):
    return ids.map(page_of, na_action="ignore").astype("Int64")


@F.pandas_udf(StringType())
def _sha(payloads):
    return payloads.map(digest_of, na_action="ignore")


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back:
    a response's from its payload, a revisit's from its headers."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc", track=True)
    write_archives(pages, folder)
    with pushdown(spark):
        full = read_archives(spark, folder).where(F.col("record_type") == "response").select(
            _page("record_id").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
            _sha("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
        again = read_archives(spark, folder, payloads=False).where(F.col("record_type") == "revisit").select(
            _page("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"),
            F.regexp_replace("digest", "^sha1:", "").alias("payload_digest"), "record_type", _page("refers_to").alias("refers_to"))
        return materialize(full.unionByName(again), "warc-rows")
