"""Corpus preparation in stages, each an operator of ``steprisk.llm`` applied to all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``. Null texts are rejected by the first stage; rows
with a null id go through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from steprisk.llm import langid, minhash, mixing, packing, pii
from steprisk.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a determinable language. The model learns from the stage's own labelled documents."""
    return langid.keep_identified(docs, langid.fit(docs.where(~langid.held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least id, of every group of near copies (five-word shingles, 0.8).

    Rows that repeat an id and its text are one document."""
    found = written(minhash.near_duplicates(docs, words=5, percent=80), "near-duplicates")
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    repeated = (
        found.where(F.col("kept") & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("doc_id")
    )
    # Written first, so that Spark knows their sizes and moves the texts only if they are too large to broadcast.
    single = docs.join(written(dropped.unionAll(repeated).distinct(), "dropped"), "doc_id", "left_anti")
    once = docs.join(written(repeated, "repeated"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(once).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; no document goes."""
    return pii.redact(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the target weights of its source ask for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs every document, copies included, into sequences."""
    return packing.op2_packing(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

# The stages are not expressible in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
