"""From documents to packed sequences: five stages over the ``llm`` operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from landflow.llm import mixing, neardup, packing, quality, toxicity
from landflow.llm.columns import plain
from landflow.session import configure, materialize, release, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stages share executors: what one stage's record batches leave in a JVM and
    its Python workers lies beside the next stage's heap, so batches are small."""
    @wraps(stage)
    def small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(small_batches(spark), docs, sf_dir)

    return small


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    safe = plain(docs)  # a score column of the user's own stays as it is
    model = toxicity.fit(safe, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(safe, model).where("predicted = 0").select(*safe.columns).toDF(*docs.columns)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.passed(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: that of the smallest doc_id;
    rows are told apart by doc_id and text."""
    return neardup.without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences. Executors hold what earlier stages left, so the
    tokenizer's cache is smaller than when packing runs alone; its workers keep it
    while the next run's stages begin."""
    return packing.pack_documents(docs, cache_bytes=64 << 20)


STAGES = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("quality rules", drop_outliers),
    ("near-duplicates", in_small_batches(drop_copies)),
    ("mixing", mix_sources),
    ("packing", in_small_batches(pack_sequences)),
]

#: The classifier and the estimates can't be said in SQL; a run is tested stage by
#: stage against brute force, with the verdicts of these two from their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release()  # the stage's small cached sides
    return docs
