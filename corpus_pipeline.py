"""A corpus pipeline: each stage applies one operator to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and all stages but the last return the
columns of ``docs``; the last returns coded blocks of token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corelode.llm import decontaminate, mixing, neardup, perplexity, rans, shared


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within their language's band.

    Null and empty texts go; a null language is a language of its own; rows that repeat
    are judged alike and all stay or go; an empty table stays empty.
    """
    return perplexity.keep_in_band(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Rows without an id stay; of rows that repeat an id one stays; null texts equal
    nothing; an empty table stays empty.
    """
    return neardup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, copied or edited.

    Rows without an id or a text stay; an empty benchmark takes nothing away.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The seeded choice of documents that fits each source's budget, in tokens of the output.

    Null and empty texts cost nothing and stay; a null source is a source of its own;
    rows that repeat are taken or left together; an empty table stays empty.
    """
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents as rANS-coded blocks of token ids, with their frequency table.

    Null and empty texts are documents without tokens; null ids stay null; repeated rows
    are coded as often as they occur; an empty table gives no rows.
    """
    return rans.blocks(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token output", tokens),
]

# Model scores, alignments and entropy coding are not expressible in SQL; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = shared.written(docs, f"stage-{k}")
    return docs
