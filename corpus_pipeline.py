"""From raw documents to token ids: the corpus pipeline, stage by stage.

Each stage takes (spark, docs, sf_dir); its result is written and read again as the
next one's docs. Null and empty texts pass the classifiers by their bias, are kept by
near-duplicate removal and end in the mix, which takes words only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, mixing, near_dup, quality, toxicity
from millrace.llm.common import Workspace, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores as toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained views reject go."""
    return quality.without_poor(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, similarity 0.8) one document stays."""
    return near_dup.without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; documents repeat or go."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, decoded again as a check."""
    return bpe.encode_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_dup", drop_copies), ("mixing", mix_sources), ("byte_bpe", tokens)]

#: The first stages learn models, which SQL cannot express; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents."""
    docs, space = table(spark, sf_dir, "documents"), Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = space.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
