"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, linededup, mixing, neardup, perplexity, pii, quotes, rans, warc, wrappers

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as WARC, read back and verified."""
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the perplexity bands keep, with score and band."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    kept = perplexity.judge(docs).filter("keep")
    return kept.select("doc_id", "lang", "source", "n_chars", "n_units", "perplexity", "ppl_low", "ppl_high")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, dup_of): each document that duplicates another, and the one that stays."""
    return neardup.groups(_table(spark, sf_dir, "documents"))


def op4_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of every page under the wrapper inferred for its host."""
    return wrappers.extract(_table(spark, sf_dir, "pages"))


def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotes."""
    return quotes.threads(_table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): each document that holds a test item."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the line chunks that another document holds first."""
    return linededup.clean(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with validated personal values replaced by pseudonyms."""
    return pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))


def op10_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as coded blocks of token ids, and the frequency table that decodes them."""
    return rans.blocks(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    here = [op1_warc, op2_perplexity, op3_simhash, op4_wrappers, op5_quotes, op6_mixing, op7_decontamination, op8_linededup, op9_pii, op10_rans]
    return {f.__name__: f for f in here}


ORACLE = {
    "op1_warc": """
        SELECT page_id, url, html, true AS block_ok, true AS payload_ok,
               CAST(strlen(html) AS BIGINT) AS n_bytes
        FROM pages
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
