"""Nearest neighbours from randomly rotated one-bit codes.

A vector is scaled to length one, rotated by a random orthogonal matrix and
kept as the signs of its coordinates with one scalar, the inner product of the
vector and its code. The code's inner product with a rotated query, over that
scalar, estimates the cosine without bias, and the scalar bounds its error. A
candidate is scored exactly only if its upper bound reaches the k-th best lower
bound found among its block.

Queries and candidates meet in blocks of bounded size, and every candidate is
looked at, so recall only misses what lies outside the error bound.

Cases: vectors that are null, empty, zero, or hold null or non-finite values
take no part; vectors of another length never meet; equal vectors tie and the
smaller id comes first; repeated rows of one id are candidates each, but for the
query's own id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landflow.session import materialize

SEED = 20_240_229
#: Width of the error bound in standard deviations of the estimate.
EPSILON = 3.0
#: Vectors and queries that meet in one block.
BLOCK, QUERY_BLOCK = 8192, 1024


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, inner product of unit vector and unit code) by row."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ turn.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(turn.shape[0])


def estimate(codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray, turn: np.ndarray,
             epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """(queries x vectors) estimated cosines, and the error bound by vector."""
    dim = turn.shape[0]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turned = (unit @ turn.T).astype(np.float32)
    est = (turned @ signs.T) / (np.sqrt(dim) * scalars)
    return est, epsilon * np.sqrt(np.maximum(0, 1 - scalars**2)) / scalars / np.sqrt(max(1, dim - 1)) + 1e-5


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, the same for equal vectors in any block."""
    q, v = query.astype(np.float64), vectors.astype(np.float64)
    return (v * q).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((q * q).sum()))


def index(vectors: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """vec_id, embedding, dim, block, code, scalar: one row per usable vector."""
    e = F.col("embedding").cast("array<double>")
    usable = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), e.alias("embedding")).where(usable & F.col("vec_id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pa.compute.list_value_length(batch["embedding"]).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                flat = part["embedding"].flatten().to_numpy().reshape(-1, dim)
                codes, scalars = encode(flat, rotation(int(dim), seed))
                yield pa.record_batch([part["vec_id"], part["embedding"], pa.array(np.full(len(flat), dim, np.int32)),
                                       pa.array([c.tobytes() for c in codes]), pa.array(scalars)],
                                      ["vec_id", "embedding", "dim", "code", "scalar"])

    import pyarrow.compute  # noqa: F401

    coded = materialize(rows.mapInArrow(run, "vec_id long, embedding array<double>, dim int, code binary, scalar double"), "codes")
    blocks = max(1, -(-coded.count() // block))
    return coded.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, epsilon: float = EPSILON, block: int = BLOCK,
           query_block: int = QUERY_BLOCK, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest."""
    coded = index(vectors, block, seed)
    asked = index(queries, query_block, seed).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"),
                                                     "dim", F.col("block").alias("qb"))
    asked = asked.dropDuplicates(["query_id", "q"])
    # every query block meets every vector block: two small lists of numbers
    grid = materialize(asked.select("dim", "qb").distinct().join(coded.select("dim", "block").distinct(), "dim"), "grid")
    left = coded.join(grid, ["dim", "block"])
    right = asked.join(grid, ["dim", "qb"])

    def meet(key, vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vs) and len(qs):
            turn = rotation(int(key[0]), seed)
            vs = vs.sort_values("vec_id", kind="stable")
            raw, ids = np.stack(vs["embedding"].to_numpy()), vs["vec_id"].to_numpy()
            codes = np.stack([np.frombuffer(c, np.uint8) for c in vs["code"]])
            asked_v, asked_id = np.stack(qs["q"].to_numpy()), qs["query_id"].to_numpy()
            for lo in range(0, len(asked_id), 256):
                est, bound = estimate(codes, vs["scalar"].to_numpy(), asked_v[lo:lo + 256], turn, epsilon)
                for e, qid, q in zip(est, asked_id[lo:lo + 256], asked_v[lo:lo + 256]):
                    other = np.flatnonzero(ids != qid)
                    if not len(other):
                        continue
                    low = (e - bound)[other]
                    kth = np.partition(low, len(low) - min(k, len(low)))[len(low) - min(k, len(low))]
                    near = other[(e + bound)[other] >= kth]
                    score = exact(q, raw[near])
                    best = np.lexsort((ids[near], -score))[:k]
                    out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = left.groupBy("dim", "block", "qb").cogroup(right.groupBy("dim", "block", "qb")).applyInPandas(
        meet, "query_id long, vec_id long, score double")
    # at most k rows per query and block
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
