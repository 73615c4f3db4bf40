"""Readers: Parquet in all the ways it is asked for, views, probes, synthetic rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One file, a list of files, a folder or a glob."""
    return spark.read.parquet(*paths)


def view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def renamed(df: DataFrame, aliases: Mapping[str, str], nulls: Mapping[str, str] | None = None) -> DataFrame:
    """All columns, some once more under other names, and typed null columns."""
    out = df
    for old, new in aliases.items():
        out = out.withColumn(new, F.col(old))
    for name, kind in (nulls or {}).items():
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def first_existing(df: DataFrame, *names: str) -> str | None:
    return next((n for n in names if n in df.columns), None)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) in order."""
    return list(df.dtypes)


def schema_matches(df: DataFrame, expected: Sequence[tuple[str, str]]) -> bool:
    return list(df.dtypes) == list(expected)


def replaced(df: DataFrame, **columns) -> DataFrame:
    """All columns, some with new contents, in place."""
    return df.select(*[(columns[c] if c in columns else F.col(c)).alias(c) for c in df.columns])


def synthetic(spark: SparkSession, rows: int, sources: Sequence[str] = ("A", "B", "C", "D"), seed: int = 7) -> DataFrame:
    """Made-up samples with fixed pseudo-random places."""
    pick = F.element_at(F.array(*[F.lit(s) for s in sources]), (F.col("id") % len(sources) + 1).cast("int"))
    material = F.when(F.col("id") % 3 == 0, "rock").when(F.col("id") % 3 == 1, "mineral").otherwise("organic")
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "id"), F.lit(1_000_000)) / 1_000_000
    return spark.range(1, rows + 1).select(F.concat(F.lit("sample:"), "id").alias("pid"), pick.alias("source"), material.alias("material"), F.round(unit("lat") * 180 - 90, 6).alias("latitude"), F.round(unit("lng") * 360 - 180, 6).alias("longitude"))


_BASE = re.compile(r"^(https?|s3a?|gs|hdfs|abfss|file)://[A-Za-z0-9][A-Za-z0-9._~:/@%+-]*$")


def base_url(value: str | None, default: str) -> str:
    """A configured base if it is a plain URL, else the default: no quotes, blanks or backslashes get in."""
    return value.rstrip("/") if value and _BASE.match(value) else default


def resolve(alias: str, manifest: Mapping[str, str], base: str) -> str:
    """The dated file that an alias names in a manifest; unknown aliases raise."""
    name = alias.removeprefix("/").removeprefix("current/")
    name = name.removesuffix(".parquet")
    if name not in manifest:
        raise KeyError(f"{alias!r} is not in the manifest")
    return f"{base.rstrip('/')}/{manifest[name]}"


def sql(spark: SparkSession, query: str, args: Sequence | Mapping | None = None) -> DataFrame:
    """A query with bound parameters."""
    return spark.sql(query, args=args) if args else spark.sql(query)
