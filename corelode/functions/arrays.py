"""Arrays of references: first elements, ordered lists, remapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first(col: Column) -> Column:
    """The first element, null for null and empty arrays (never an error)."""
    return F.get(col, F.lit(0))


def length(col: Column) -> Column:
    """Number of elements, null for null."""
    return F.when(col.isNotNull(), F.size(col))


def exploded(df: DataFrame, array: str, value: str, ordinal: str | None = None) -> DataFrame:
    """One row for each element; ``ordinal`` counts from one.  Null and empty arrays give none."""
    if ordinal is None:
        return df.withColumn(value, F.explode(array))
    others = [c for c in df.columns if c not in (value, ordinal)]
    return df.select(*others, F.posexplode(array).alias(ordinal, value)).withColumn(ordinal, F.col(ordinal) + 1)


def ordered_list(value: Column, ordinal: Column) -> Column:
    """Aggregate: the values in order of (ordinal, value)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(ordinal.alias("o"), value.alias("v")))), lambda z: z["v"])


def first_by(value: Column, ordinal: Column, keep: Column) -> Column:
    """Aggregate: the value with the smallest ordinal among those kept."""
    return F.min_by(F.when(keep, value), F.when(keep, F.struct(ordinal, value)))


def distinct_text(value: Column) -> Column:
    """Aggregate: the distinct values in order, joined by blanks."""
    return F.array_join(F.array_sort(F.collect_set(value)), " ")


def remap(df: DataFrame, key: str, array: str, mapping: DataFrame, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """(key, array): the array with ids replaced, in order; ids without a new one are dropped.

    An array that ends up empty is null, since an aggregate of no rows is no row.
    """
    flat = df.select(key, F.posexplode(array).alias("_pos", "_old"))
    hit = flat.join(mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new")), "_old")
    return hit.groupBy(key).agg(ordered_list(F.col("_new"), F.col("_pos")).alias(array))


def contains_any(col: Column, values: Sequence) -> Column:
    return F.arrays_overlap(col, F.array(*[F.lit(v) for v in values])) if values else F.lit(False)
