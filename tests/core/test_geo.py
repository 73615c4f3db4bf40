import struct

import pyarrow as pa

import pytest
from pyspark.sql import functions as F

from corelode.functions import geo
from corelode.operators import clusters


def test_points_of_both_byte_orders(spark):
    big = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    srid = struct.pack("<BIIdd", 1, 0x20000001, 4326, 5.0, 6.0)
    line = struct.pack("<BII", 1, 2, 0) + bytes(16)
    rows = [(geo.encode_point(1.0, 2.0),), (big,), (srid,), (line,), (None,), (b"\x01",), (geo.encode_point(float("nan"), 1.0),)]
    got = spark.createDataFrame(rows, "g binary").select(geo.point(F.col("g")).alias("p")).collect()
    assert [(r.p.x, r.p.y) if r.p and r.p.x is not None else None for r in got] == [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0), None, None, None, None]


def test_padding_clamps_and_wraps():
    b = geo.BBox(-80, 150, 80, -150).padded(0.25)
    assert (b.south, b.north) == (-90, 90) and b.wraps and (b.west, b.east) == (135, -135)
    assert geo.BBox(0, -170, 10, -100).padded(0.5) == geo.BBox(-5, 155, 15, -65)
    w = geo.BBox(0, -170, 1, 170).padded(0.3)
    assert (w.west, w.east) == (-180, 180)


def test_boxes_filter(spark):
    df = spark.createDataFrame([(0.0, 179.0), (0.0, -179.0), (0.0, 0.0), (50.0, 179.0), (None, 1.0)], "lat double, lng double")
    n = lambda b: df.filter(b.where(F.col("lat"), F.col("lng"))).count()
    assert n(geo.BBox(-10, 170, 10, -170)) == 2 and n(geo.BBox(-10, -10, 10, 10)) == 1 and n(geo.BBox(-90, -180, 90, 180)) == 4


@pytest.mark.parametrize("alt,box,want", [(2e7, geo.BBox(0, 0, 1, 1), True), (1e5, None, True), (1e5, geo.BBox(-89, -179, 89, 179), True), (1e5, geo.BBox(-89, 179, 89, -179), False), (1e5, geo.BBox(0, 0, 1, 1), False)])
def test_global_view(alt, box, want):
    assert geo.is_global_view(alt, box) is want


def test_tiers():
    assert [geo.resolution_for(a) for a in (4e6, 3e6, 4e5, 3e5)] == [4, 6, 6, 8]
    assert geo.point_mode(1e5, False) and not geo.point_mode(2e5, True) and geo.point_mode(150_000, True) and not geo.point_mode(150_000, False)
    assert [geo.heatmap_radius(n) for n in (0, 300, 35_000, 10**7)] == [30, 30, 6, 6]
    assert geo.valid_cell_hex("8428309ffffffff") and not geo.valid_cell_hex("xyz")


def test_cells_and_clusters(spark):
    rows = [("a", 1.0, 1.0, "A"), ("b", 1.001, 1.001, "B"), ("c", 1.002, 1.002, "B"), ("d", 1.0, 1.0, "A"), ("e", 60.0, 60.0, None), ("f", None, 1.0, "A")]
    df = spark.createDataFrame(rows, "pid string, latitude double, longitude double, source string").withColumn("cell", geo.cell(F.col("latitude"), F.col("longitude"), 4))
    got = clusters.cluster_summary(df, "cell", 4).orderBy("sample_count").collect()
    assert [(r.sample_count, r.dominant_source, r.source_count) for r in got] == [(1, None, 0), (4, "A", 2)]
    assert got[1].center_lat == round((1 + 1.001 + 1.002 + 1) / 4, 6)
    assert clusters.dense_cells(df, "cell", 2).first().source == "A"
    card = clusters.cell_card(df, "cell", got[1].h3_cell).first()
    assert (card.sample_count, card.source_count, card.dominant_source) == (4, 2, "A")
    assert clusters.clusters_of_sources(clusters.cluster_summary(df, "cell"), ["A"]).count() == 1
    assert clusters.clusters_of_sources(clusters.cluster_summary(df, "cell"), []).count() == 0


def test_heatmap_counts_every_sample(spark):
    df = spark.range(1000).select((F.col("id") % 100 - 50).cast("double").alias("latitude"), ((F.col("id") * 7) % 360 - 180).cast("double").alias("longitude"))
    for box in (geo.BBox(-60, -180, 60, 180), geo.BBox(-60, 100, 60, -100)):
        inside = df.filter(box.where(F.col("latitude"), F.col("longitude"))).count()
        got = clusters.heatmap(df, box, 64)
        assert got.agg(F.sum("n")).first()[0] == inside
        assert got.filter("x < 0 or x > 63 or y < 0 or y > 63").count() == 0


def test_points_of_arrays_are_those_of_single_values():
    good = [geo.encode_point(1.5, -2.0), geo.encode_point(float("nan"), 1.0), struct.pack(">BIdd", 0, 1, 3.0, 4.0), struct.pack("<BIIdd", 1, 0x20000001, 4326, 5.0, 6.0), struct.pack("<BIdd", 1, 2, 3.0, 4.0), b"", b"x" * 21, None]
    for blobs in (good, good[:1], [], [None]):
        got = geo.point_array(pa.array(blobs, pa.binary())).to_pylist()
        want = [geo.decode_point(b) for b in blobs]
        assert [(r["x"], r["y"]) for r in got] == [w or (None, None) for w in want]
