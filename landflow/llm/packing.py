"""Cost-balanced packing of documents into sequences.

A document's attention cost is estimated as ``linear * n + quadratic * n * n``
of its tokens in a sequence. Blocks of documents are packed where they are
read, without a shuffle: full-length pieces of long documents fill sequences
of their own, the rest goes, longest first, to the sequence of lowest cost
that has room, and what fits nowhere is cut over the room that is left. A block
of ``t`` tokens takes ``ceil(t / length)`` sequences, so only its last tokens
can be padded.

``pack_documents`` gives the pieces with their token ids, ``sequences`` joins them
to padded training sequences (a group holds at most ``length`` pieces).

Cases: a null or empty text is its end id alone; equal documents are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landflow.llm.tokens import encoder, tokenizer_path

LENGTH = 2048
#: Tokens gathered before a block is packed (a longer document is its own).
BLOCK_TOKENS = 4_000_000
#: Cost of a token, and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
VOCABULARY, END = "byte_bpe_50k.json", 1
#: ``ids``: little-endian unsigned 32-bit ids of the piece.
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")
#: Bytes of distinct chunks that a worker keeps: less only costs time.
CACHE_BYTES = 448 << 20
#: Pieces a record batch.
PIECES = 1024


def pack(lengths: list[int], length: int = LENGTH, linear: float = LINEAR,
         quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    pieces, rest, made = [], [], 0
    for i, n in enumerate(lengths):
        for start in range(0, n - length + 1, length):
            pieces.append((i, start, length, made, 0))
            made += 1
        if n % length:
            rest.append((n % length, i, n - n % length))
    rest.sort(key=lambda r: (-r[0], r[1]))
    count = -(-sum(r[0] for r in rest) // length)
    used, cost = np.zeros(count, np.int64), np.zeros(count)
    left = []
    for n, i, start in rest:
        k = int(np.where(used + n <= length, cost, np.inf).argmin())
        if used[k] + n > length:
            left.append((n, i, start))
            continue
        pieces.append((i, start, n, made + k, int(used[k])))
        used[k] += n
        cost[k] += linear * n + quadratic * n * n
    room = [k for k in range(count) if used[k] < length]
    for n, i, start in left:
        while n:
            k = room[-1]
            cut = min(n, int(length - used[k]))
            pieces.append((i, start, cut, made + k, int(used[k])))
            used[k] += cut
            start, n = start + cut, n - cut
            if used[k] == length:
                room.pop()
    return pieces


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end: int = END,
                   length: int = LENGTH, block_tokens: int = BLOCK_TOKENS,
                   cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """One row per piece, as in SCHEMA. A sequence id is the partition's number
    and a count within it."""
    path = vocabulary or tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(path, cache_bytes), np.array([end], "<u4").tobytes()
        made = TaskContext.get().partitionId() << 33
        ids: list[bytes] = []
        keys: list[int | None] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            sizes = [len(b) // 4 for b in ids]
            out = pack(sizes, length)
            for at in range(0, len(out), PIECES):
                rows = [(keys[i], s, n, sizes[i], made + q, o, ids[i][4 * s:4 * (s + n)])
                        for i, s, n, q, o in out[at:at + PIECES]]
                cols = list(zip(*rows))
                yield pa.record_batch([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1], pa.binary())],
                                      ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            made += 1 + max((q for _, _, _, q, _ in out), default=-1)
            ids.clear()
            keys.clear()

        held = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                rows = batch.slice(lo, 200)
                for key, found in zip(rows["doc_id"].to_pylist(), enc.many(rows["text"].to_pylist())):
                    ids.append(found + tail)
                    keys.append(key)
                    held += len(ids[-1]) // 4
                    if held >= block_tokens:
                        yield from flush()
                        held = 0
        if keys:
            yield from flush()

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame, pad: int = 0, length: int = LENGTH) -> DataFrame:
    """sequence_id, n_tokens, ids: a sequence's ids, padded to ``length`` (a full
    row for a trainer), as little-endian unsigned 32-bit ids."""
    tail = F.lit(np.full(length, pad, "<u4").tobytes())
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return rows.select("sequence_id", "n_tokens", F.substring(F.concat(ids, tail), 1, 4 * length).alias("ids"))
