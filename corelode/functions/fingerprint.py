"""Order-independent fingerprints of tables, used to tie artefacts of one build together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(cols: Sequence[str]) -> Column:
    """60-bit hash of a row that tells null from the empty string; any engine with MD5 can compute it."""
    parts = [F.when(F.col(c).isNull(), F.lit(chr(0))).otherwise(F.concat(F.lit(chr(1)), F.col(c).cast("string"))) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(chr(31), *parts)), 1, 15), 16, 10).cast("long")


def xor_id(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, one column ``build_id``: the XOR of the row hashes, in hex."""
    return df.agg(F.lower(F.hex(F.coalesce(F.bit_xor(row_hash(cols)), F.lit(0).cast("long")))).alias("build_id"))


def full_id(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """XOR, sum and count of the row hashes: changes when a row is repeated, too."""
    h = df.select(row_hash(cols).alias("h"))
    total = F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string")
    return h.agg(F.concat_ws("-", F.lower(F.hex(F.coalesce(F.bit_xor("h"), F.lit(0).cast("long")))), total, F.count(F.lit(1)).cast("string")).alias("build_id"))
