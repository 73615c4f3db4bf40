"""Set operations with the meaning their names have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks."""
    return a.select(*b.columns).subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that one side has and the other lacks, with ``side``; each side is read and shuffled once."""
    names = b.columns
    flags = lambda left: (F.lit(left).alias("_left"), F.lit(not left).alias("_right"))
    seen = a.select(*names, *flags(True)).union(b.select(*names, *flags(False))).groupBy(*names).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    return seen.filter(F.col("_left") != F.col("_right")).select(*names, F.when(F.col("_left"), "left").otherwise("right").alias("side"))


def union_all(a: DataFrame, *others: DataFrame) -> DataFrame:
    """By name; a column that one side lacks is null there."""
    for b in others:
        a = a.unionByName(b, allowMissingColumns=True)
    return a


def union_distinct(a: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(a, *others).distinct()


def compare(a: DataFrame, b: DataFrame, key: str, *values: str) -> DataFrame:
    """Keys whose values differ, or that one side lacks; nulls are equal to nulls."""
    la = a.select(key, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("in_a"))
    lb = b.select(key, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("in_b"))
    differ = F.col("in_a").isNull() | F.col("in_b").isNull()
    for v in values:
        differ = differ | ~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
    return la.join(lb, key, "full").filter(differ)


def missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key ``b`` lacks; a null key is never found."""
    return a.join(b.select(key), key, "left_anti")
