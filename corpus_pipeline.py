"""Training-corpus pipeline: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared checkpoint folder and reads it back as the
next stage's docs.  All but the last return the columns of ``documents``; the
last returns piece ids in place of texts.  From the second stage on ``lang`` is the
language predicted from the text, up to the last stage's rows.

No stage is SQL-expressible as a whole (learned rules, a trained network, a
randomised join), so ORACLE_SQL is None and tests hold each stage against its
operator's brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctpulse.llm import decontaminate, jaccard_join, language_id, piece_codec, quality_rules
from acctpulse.llm.common import written

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go; the others' ``lang`` becomes the predicted one."""
    return language_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return jaccard_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the whole texts."""
    return piece_codec.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
