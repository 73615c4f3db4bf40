"""What a screen asks for: pages, details, exports, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

PAGE_SIZE = 100
POINT_BUDGET = 5000
CSV_CAP = 50_000
CSV_COLUMNS = ("pid", "label", "source", "latitude", "longitude", "place_name", "result_time", "material", "context", "object_type", "url")
RESOLVER = "https://n2t.net/"


def page(df: DataFrame, number: int, size: int = PAGE_SIZE, key: str = "pid") -> DataFrame:
    """The rows of one page in key order."""
    return df.orderBy(key).offset(number * size).limit(size)


def page_with(df: DataFrame, details: DataFrame, number: int, size: int = PAGE_SIZE, key: str = "pid") -> DataFrame:
    """The page first, its details after: the join sees one page of rows."""
    return page(df.filter(F.col(key).isNotNull()), number, size, key).join(details, key, "left")


def total(df: DataFrame, key: str = "pid") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("total"))


def points(df: DataFrame, budget: int = POINT_BUDGET, key: str = "pid") -> DataFrame:
    return df.orderBy(key).limit(budget)


def count_if_capped(df: DataFrame, shown: int, cap: int) -> int:
    """The real number of rows: counted only where the cap was reached."""
    return df.count() if shown >= cap else shown


def detail(samples: DataFrame, key: str, value, concepts: DataFrame, columns: Sequence[str], labels: DataFrame | None = None) -> DataFrame:
    """One sample with the labels of its first concepts.

    ``columns`` hold arrays of concept row ids.  The sample is picked first, so the
    joins see one row.  Labels of one language only are joined (a vocabulary with
    several would multiply the row); the URI's tail stands in for a missing one.
    """
    one = samples.filter(F.col(key) == F.lit(value)).limit(1)
    for c in columns:
        ids = concepts.select(F.col("row_id").alias(f"{c}_id"), F.col("pid").alias(f"{c}_uri"))
        one = one.withColumn(f"{c}_id", F.get(c, F.lit(0))).join(ids, f"{c}_id", "left").drop(f"{c}_id")
        if labels is not None:
            names = labels.filter(F.col("lang") == "en").groupBy(F.col("uri").alias(f"{c}_uri")).agg(F.min("pref_label").alias(f"{c}_label"))
            one = one.join(names, f"{c}_uri", "left").withColumn(f"{c}_label", tx.label_or_tail(F.col(f"{c}_label"), F.col(f"{c}_uri")))
    return one


def with_labels(df: DataFrame, uri: str, vocabulary: DataFrame, lang: str = "en") -> DataFrame:
    """``df`` with ``label`` of a concept column, falling back to the URI's tail."""
    v = vocabulary.filter(F.col("lang") == lang).groupBy(F.col("uri").alias(uri)).agg(F.min("pref_label").alias("label"))
    return df.join(v, uri, "left").withColumn("label", tx.label_or_tail(F.col("label"), F.col(uri)))


def csv_rows(df: DataFrame, columns: Sequence[str] = CSV_COLUMNS, cap: int = CSV_CAP, key: str = "pid") -> DataFrame:
    """(line): the export, ordered by key, capped, guarded against formulas, quoted; no header."""
    rows = df.filter(F.col(key).isNotNull()).orderBy(key).limit(cap)
    have = set(df.columns)

    def field(c: str) -> Column:
        if c == "url" and "url" not in have:
            return tx.csv_field(F.concat(F.lit(RESOLVER), F.col(key)))
        kind = dict(df.dtypes).get(c, "string")
        return tx.csv_field(tx.place_text(F.col(c)) if kind.startswith("array") else F.col(c))

    return rows.select(F.concat_ws(",", *[field(c) for c in columns]).alias("line"))


def search_area(scored: DataFrame, samples: DataFrame, where: Column, top: int = 50, key: str = "pid") -> DataFrame:
    """Best matches inside an area: the area first, then the ranking, ties by key."""
    return samples.filter(where).join(scored, key).orderBy(F.desc("score"), F.asc(key)).limit(top)


def search_world(scored: DataFrame, samples: DataFrame, top: int = 50, key: str = "pid") -> DataFrame:
    """Best matches anywhere: the ranking first, so that only they are joined; they stay without a place, too."""
    best = scored.orderBy(F.desc("score"), F.asc(key)).limit(top)
    return best.join(samples, key, "left").orderBy(F.desc("score"), F.asc(key))


def with_thumbnail_first(df: DataFrame, key: str = "pid") -> DataFrame:
    return df.withColumn("has_thumbnail", F.col("thumbnail_url").isNotNull()).orderBy(F.desc("has_thumbnail"), F.asc(key))


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Sorted with nulls last in both directions; a leading ``-`` sorts downwards."""
    return df.orderBy(*[F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in cols])
