"""Token ids in fixed-width bit-packed files.

A file holds a JSON header, then blocks of ``block`` ids, each id in the least
bits that the vocabulary needs (most significant first) and each block padded
to a byte, then the documents' table (doc_id, first id, ids). Block ``k`` starts
at ``data + k * ceil(block * bits / 8)``, so any id is read with one seek, and
numpy unpacks a block at once.

Cases: a null or empty text is its end id alone; repeated rows and null ids are
written each, nulls first; an empty table makes no file; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landflow.llm.files import opened, put
from landflow.llm.tokens import encoder, tokenizer_path, vocabulary_size
from landflow.session import materialize, scratch_path

MAGIC = b"TIDS0001"
VOCABULARY, END = "word_bpe_49k.json", 2
#: Bytes of encoded chunks that a worker keeps (nothing else runs beside it).
CACHE_BYTES = 448 << 20
#: Ids per block, and ids after which a new file is begun (bounds a task's memory).
BLOCK, FILE_IDS = 8192, 8_000_000


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, most significant first, padded to a byte; an id
    that needs more bits is refused."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} doesn't fit {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8)).tobytes()


def unpack_bits(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    out = np.zeros(count, "<u4")
    for k in range(bits):
        out = (out << np.uint32(1)) | flat[:, k]
    return out


def file_bytes(docs: list[tuple[int | None, bytes]], bits: int, block: int = BLOCK) -> bytes:
    """A whole file for documents given as little-endian 32-bit ids."""
    ids = np.frombuffer(b"".join(d for _, d in docs), "<u4")
    counts = np.array([len(d) // 4 for _, d in docs], "<i8")
    body = b"".join(pack_bits(ids[k:k + block], bits) for k in range(0, len(ids), block))
    keys = np.array([k if k is not None else 0 for k, _ in docs], "<i8")
    table = np.stack([keys, np.cumsum(counts) - counts, counts, [k is None for k, _ in docs]]).astype("<i8").tobytes()
    head = json.dumps({"bits": bits, "block": block, "ids": len(ids), "docs": len(docs), "body": len(body)}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + body + table


class TokenFile:
    """Random access to one file through any seekable stream."""

    def __init__(self, stream) -> None:
        self.f = stream
        if stream.read(8) != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(stream.read(4), "little")
        self.head = json.loads(stream.read(n))
        self.data = 12 + n
        stream.seek(self.data + self.head["body"])
        self.docs = np.frombuffer(stream.read(32 * self.head["docs"]), "<i8").reshape(4, -1)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count``: only their blocks are read."""
        bits, block = self.head["bits"], self.head["block"]
        first, last = start // block, (start + count - 1) // block
        step = -(-block * bits // 8)
        self.f.seek(self.data + first * step)
        out = []
        for k in range(first, last + 1):
            here = min(block, self.head["ids"] - k * block)
            out.append(unpack_bits(self.f.read(-(-here * bits // 8)), here, bits))
        return np.concatenate(out)[start - first * block:][:count]


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END,
                 size: int | None = None, block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files in doc_id order; a row (part, file, path, ids) for each.
    The bits of an id come from the vocabulary's ``size``, that of the tokenizer
    unless it is given."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    bits = max(1, max(end, (size or vocabulary_size(path)) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(path, CACHE_BYTES), np.array([end], "<u4").tobytes()
        part, made, held, total = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/part-{part:06d}-{made:06d}.tids"
            put(uri, file_bytes(held, bits, block))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([made], pa.int32()), pa.array([uri]),
                                    pa.array([total], pa.int64())], ["part", "file", "path", "ids"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                rows = batch.slice(lo, 200)
                for key, ids in zip(rows["doc_id"].to_pylist(), enc.many(rows["text"].to_pylist())):
                    held.append((key, ids + tail))
                    total += len(held[-1][1]) // 4
                    if total >= file_ids:
                        yield flush()
                        held, total, made = [], 0, made + 1
        if held:
            yield flush()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.crc32(F.encode("text", "utf-8")).asc_nulls_first()]
    rows = docs.select(docs["doc_id"].cast("long"), "text")
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(ranged.mapInArrow(run, "part int, file int, path string, ids long"), "token-files")


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files of ``write_tokens``."""
    w = Window.orderBy("part", "file")  # one row per file
    placed = files.withColumn("before", F.sum("ids").over(w) - F.col("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch["path"].to_pylist(), batch["before"].to_pylist()):
                with opened(uri) as stream:
                    f = TokenFile(stream)
                    keys, starts, counts, nulls = f.docs
                    crc, at = [], 0
                    for lo in range(0, len(keys), 1000):  # a bounded run of documents at once
                        n = int(counts[lo:lo + 1000].sum())
                        ids = f.ids(at, n)
                        crc += [zlib.crc32(ids[s - at:s - at + c]) for s, c in zip(starts[lo:lo + 1000], counts[lo:lo + 1000])]
                        at += n
                    yield pa.record_batch([pa.array(keys, pa.int64(), mask=nulls.astype(bool)), pa.array(starts + before),
                                           pa.array(counts), pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = files.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame) -> DataFrame:
    return read_tokens(write_tokens(docs, scratch_path(docs.sparkSession, "tokens", track=True)))
