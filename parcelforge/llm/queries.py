"""The registered queries of the training-data operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelforge.llm import bytebpe, chat, exactdup, licences, neardup, packing, repeats, simhash, tokencount, toxicity
from parcelforge.llm.spill import bounded_batches, result_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    network = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents.select("doc_id", "text"), network)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.render(rows.unionByName(extra)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.deduplicate(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"))
    return result_table(packed.select("sequence_id", "size", "used", F.col("ids").alias("doc_ids"), "pieces", "starts", "offsets", "lengths", F.sha2("content", 256).alias("content_sha256")), "op7-result")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicate(_table(spark, sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bytebpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity, op2_minhash, op3_token_counts, op4_chat, op5_simhash,
            op6_exact_dedup, op7_packing, op8_substring_dedup, op9_licences, op10_byte_bpe,
        )
    }
