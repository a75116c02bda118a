"""Corpus pipeline: quality rules, near-duplicate removal, PII surrogates, source mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before it kept,
and returns a DataFrame; all but the last return the columns of ``documents``. ``run`` writes
each stage's rows as Parquet to the shared folder and reads them back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import mixing, pii_surrogates, quality_rules, sentencepiece_nbest, simhash
from lakeops.llm.common import ship_package, stash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep, without the lines that failed."""
    return quality_rules.clean_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by surrogates."""
    return pii_surrogates.replace_private(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document is there as often as it was drawn, shard by shard."""
    return mixing.mix(docs)


KEPT_STRETCHES = 100_000  # the stages before leave the executors less memory


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the best segmentation, their number and score, whether all paths decode to
    the text, and the other paths of the N best."""
    best = F.col("encoded.paths")[0]
    return sentencepiece_nbest.encode(docs, kept=KEPT_STRETCHES).select(
        "doc.doc_id", "doc.lang", "doc.source", best["ids"].alias("ids"),
        F.size(best["ids"]).cast("long").alias("n_pieces"), best["score"].alias("score"),
        F.col("encoded.round_trip").alias("round_trip"),
        F.slice("encoded.paths", F.lit(2), F.size("encoded.paths")).alias("other_paths"),
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("pii_surrogates", pii_stage),
    ("mix_sources", mixing_stage),
    ("sentencepiece", tokens_stage),
]

# The fingerprints (XXH64) and the segmentation have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stash(docs, f"pipeline-{name}")
    return docs
