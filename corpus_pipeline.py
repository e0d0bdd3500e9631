"""A training corpus from ``documents``: each stage applies one operator, and its decisions take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelforge.llm import exactdup, neardup, packing, repeats, toxicity
from parcelforge.llm.spill import bounded_batches, drop_table, write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below 0.5, trained on the labels outside the held-out fifth."""
    bounded_batches(spark)
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(*COLUMNS), network, score_col="_toxicity")
    return scored.where("_toxicity < 0.5").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document with the largest id."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    gone = exactdup.deduplicate(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_sha256").alias("_digest"))
    # id and text together: a row that shares its id with a dropped one but not its text stays
    digest = exactdup.digest_of(F.col("text"))
    return docs.join(gone, (digest == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by five-word shingles at similarity 0.8 or more."""
    bounded_batches(spark)
    docs = docs.select(*COLUMNS)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    marked = neardup.near_duplicates(docs.select("doc_id", "text", digest.alias("_digest")), shingle=5, percent=80, carry=["_digest"])
    gone = marked.where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("_carry._digest").alias("_digest"))
    return docs.join(gone, (digest == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 or more words that also stand in a document with a smaller id."""
    bounded_batches(spark)
    cut = repeats.deduplicate(docs, with_text=True, carry=["lang", "source"])
    return cut.select(
        "doc_id", F.col("kept_text").alias("text"), F.col("_carry.lang").alias("lang"), F.col("_carry.source").alias("source"),
        F.length("kept_text").cast("long").alias("n_chars"),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of byte tokens: their contents, and the documents and places these come from."""
    return packing.pack_documents(docs).withColumnRenamed("ids", "doc_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack),
]

#: The trained network of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for at, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if at == len(STAGES) - 1:
            return out
        docs = write_table(out, f"pipeline-{name.replace(' ', '-')}")
        if written is not None:
            drop_table(written)
        written = docs
