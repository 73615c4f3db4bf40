"""Histograms and data-quality figures, each in as few scans as it needs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, col: str, top: int | None = None, name: str = "n") -> DataFrame:
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return out if top is None else out.orderBy(F.desc(name), F.asc_nulls_last(col)).limit(top)


def shares(df: DataFrame, col: str) -> DataFrame:
    """(col, n, pct): counts and their percentage of all rows."""
    n = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2))


def metrics(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """(metric, n): rows for which each condition holds, in one scan."""
    names = list(named)
    one = df.agg(*[F.count_if(named[k]).alias(f"m{i}") for i, k in enumerate(names)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"m{i}").alias("n")) for i, k in enumerate(names)])).alias("r")).select("r.*")


def rate(df: DataFrame, by: str, condition: Column) -> DataFrame:
    """(by, n, pct) of the rows for which a condition holds."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100, 2).alias("pct"))


def coordinates(df: DataFrame, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count(lat).alias("located"), F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lng).alias("west"), F.max(lng).alias("east"), F.round(F.avg(lat), 6).alias("mean_lat"), F.round(F.avg(lng), 6).alias("mean_lng"))


def collection_totals(df: DataFrame, by: str, located: Column) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(located).alias("located"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
