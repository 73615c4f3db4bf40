"""Cells, clusters, heatmaps and other spatial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import BBox, pixel_bins


def cluster_summary(df: DataFrame, cell: str, resolution: int | None = None, lat: str = "latitude", lng: str = "longitude", source: str = "source") -> DataFrame:
    """Per cell: samples, rounded mean centre, sources, and the source with most samples.

    Ties of the dominant source go to the first name.  Counting by (cell, source)
    first leaves one small row a pair, from which all the figures of a cell follow.
    """
    part = df.filter(F.col(cell).isNotNull()).groupBy(F.col(cell).alias("h3_cell"), F.col(source).alias("s")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(lat).alias("a"), F.count(lat).alias("na"), F.sum(lng).alias("b"), F.count(lng).alias("nb")
    )
    best = F.min(F.struct((-F.col("c")).alias("c"), F.col("s").isNull().alias("z"), F.col("s").alias("s")))["s"]
    out = part.groupBy("h3_cell").agg(
        F.sum("c").cast("int").alias("sample_count"),
        F.round(F.try_divide(F.sum("a"), F.sum("na")), 6).alias("center_lat"),
        F.round(F.try_divide(F.sum("b"), F.sum("nb")), 6).alias("center_lng"),
        best.alias("dominant_source"),
        F.count("s").cast("int").alias("source_count"),
    )
    return out if resolution is None else out.withColumn("resolution", F.lit(resolution).cast("int"))


def dominant(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, value, n): the most frequent value of each group by row number, ties to the first."""
    n = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by).orderBy(F.desc("n"), F.asc_nulls_last(value))
    return n.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


def cell_card(df: DataFrame, cell: str, value: int) -> DataFrame:
    """One row for a cell: count, means, most frequent source, sources."""
    return df.filter(F.col(cell) == F.lit(value)).agg(
        F.count(F.lit(1)).alias("sample_count"), F.round(F.avg("latitude"), 6).alias("center_lat"), F.round(F.avg("longitude"), 6).alias("center_lng"), F.mode("source", True).alias("dominant_source"), F.count_distinct("source").alias("source_count")
    )


def heatmap(df: DataFrame, box: BBox, size: int = 512, lat: str = "latitude", lng: str = "longitude") -> DataFrame:
    """(x, y, n, weight): samples of each pixel bin of the box; every sample counts."""
    x, y = pixel_bins(F.col(lat), F.col(lng), box, size)
    inside = df.filter(box.where(F.col(lat), F.col(lng)))
    return inside.groupBy(x.alias("x"), y.alias("y")).agg(F.count(F.lit(1)).alias("n")).withColumn("weight", F.log1p("n"))


def in_view(summary: DataFrame, box: BBox) -> DataFrame:
    """(clusters, samples) whose cluster centre is in the box: close to, not equal to, the samples there."""
    return summary.filter(box.where(F.col("center_lat"), F.col("center_lng"))).agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("sample_count"), F.lit(0)).alias("samples"))


def region(lat: Column, lng: Column) -> Column:
    """A coarse region by centre."""
    return (
        F.when(lat.between(35, 72) & lng.between(-25, 45), "Europe")
        .when(lat.between(-35, 37) & lng.between(-20, 52), "Africa")
        .when(lat.between(5, 80) & lng.between(45, 180), "Asia")
        .when(lat.between(10, 84) & lng.between(-170, -50), "North America")
        .when(lat.between(-56, 13) & lng.between(-82, -34), "South America")
        .when(lat.between(-50, 0) & lng.between(110, 180), "Oceania")
        .otherwise("Other")
    )


def dense_cells(df: DataFrame, cell: str, least: int = 100) -> DataFrame:
    """Cells with more than ``least`` samples: count, most frequent source (ties to the first), region."""
    n = df.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.mode("source", True).alias("source"), F.avg("latitude").alias("lat"), F.avg("longitude").alias("lng")).filter(F.col("n") > least)
    return n.select(cell, "n", "source", region(F.col("lat"), F.col("lng")).alias("region"))


def clusters_of_sources(summary: DataFrame, sources: list[str]) -> DataFrame:
    """Summary rows by dominant source: an approximation of filtering the samples."""
    return summary.filter(F.col("dominant_source").isin(sources)) if sources else summary.limit(0)
