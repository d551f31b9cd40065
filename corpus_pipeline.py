"""From raw documents to sharded training documents.

Each stage takes all rows that the one before kept, is written as Parquet and
read again, so that a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import circulant_minhash, decontaminate, poisson_mix, slots, toxicity
from millrace.session import work_dir
from millrace.sources.tables import load

SHARDS = 40


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents, drop what is predicted to be toxic."""
    return toxicity.accepted(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates (five words, similarity 0.8 or more): one row of each group stays."""
    return circulant_minhash.deduplicated(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"), size=10)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document by its source's target rate, shuffled."""
    return poisson_mix.mix(docs, seed=17, temperature=0.7).drop("n_copies", "copy")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of each row that is left."""
    placed = slots.assign(docs, work_dir(spark, "slots"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash", minhash_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Training, hashing and the slot map have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
