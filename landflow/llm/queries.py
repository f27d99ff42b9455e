"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landflow.llm import ann, maxent, mixing, neardup, packing, quality, sharding, spelling, tokenbin, toxicity, turntrie, urlfilter, warc
from landflow.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.scored(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).drop("h")


def op4_token_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(_table(spark, sf_dir, "documents"))


def op5_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op6_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_hash_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(turntrie.rebuilt(turntrie.sequences(_table(spark, sf_dir, "conversations"))))


def op12_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(_table(spark, sf_dir, "documents"))


def op13_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_minhash_forest, op3_quality_mcd, op4_token_bits, op5_url_cascade,
    op6_one_bit_search, op7_hilbert_shards, op8_warc, op9_cost_packing, op10_hash_mix,
    op11_turn_trie, op12_maxent, op13_spelling_trie)}

#: The others' results come from fits, hashes of Spark's, files or tokenizers,
#: which SQL can't express; they are tested against brute force.
ORACLE = {"op5_url_cascade": urlfilter.ORACLE, "op10_hash_mix": mixing.ORACLE, "op11_turn_trie": turntrie.ORACLE,
          "op13_spelling_trie": spelling.ORACLE}
