"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    circulant_minhash,
    decontaminate,
    hard_negatives,
    mtree,
    notices,
    oracles,
    poisson_mix,
    pseudonyms,
    slots,
    suffix_repeats,
    token_store,
    tokens,
    toxicity,
    whitening,
)
from millrace.session import work_dir
from millrace.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_repeats")
def op1_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_repeats.without_repeats(load(spark, folder, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_mtree_top_k", oracles.TOP_K)
def op2_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.search(load(spark, folder, "embeddings"), k=5, every=50, scale=256)


@query("op3_virtual_slots")
def op3_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    placed = slots.assign(load(spark, folder, "documents"), work_dir(spark, "slots"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Key of the registered query; a real run takes its own from a secret store.
PSEUDONYM_KEY = "registered-query-key"


@query("op4_feistel_pseudonyms")
def op4_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query("op5_poisson_mix", oracles.MIX)
def op5_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    return poisson_mix.mix(load(spark, folder, "documents"), seed=17, temperature=0.7)


@query("op6_prefix_token_counts")
def op6_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, tokenizer_file(), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op7_token_store")
def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    token_store.write_tokens(load(spark, folder, "documents"), tokenizer_file(), path, end_id=1)
    found = token_store.read_tokens(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


@query("op8_rare_word_windows", oracles.CONTAMINATION)
def op8_rare_word_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(load(spark, folder, "documents"), load(spark, folder, "benchmark"), size=10)


@query("op9_circulant_minhash", oracles.NEAR_DUPLICATES)
def op9_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return circulant_minhash.near_duplicates(load(spark, folder, "documents"), percent=85)


@query("op10_counterfactual_toxicity")
def op10_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query("op11_notice_search")
def op11_notice_search(spark: SparkSession, folder: str) -> DataFrame:
    found = notices.scan_notices(load(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op12_gnat_hard_negatives", oracles.HARD_NEGATIVES)
def op12_gnat_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(load(spark, folder, "embeddings")).withColumn("label", moved)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, window=(50, 95))


@query("op13_lanczos_whitening")
def op13_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(load(spark, folder, "embeddings"), k=32, scale=64, shift=1_000_000)
