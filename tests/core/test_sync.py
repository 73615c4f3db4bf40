"""Overlays and synchronisation on small graphs with known outcomes."""

import pytest
from pyspark.sql import functions as F

from corelode.operators import graph, sync
from corelode.plans import checks as ck

REFS = ["p__has_material_category", "p__has_sample_object_type", "p__produced_by", "p__sampling_site", "p__sample_location", "p__site_location", "p__responsibility", "p__keywords"]
SCHEMA = "row_id long, pid string, otype string, n string, label string, scheme_name string, scheme_uri string, description string, thumbnail_url string, " + ", ".join(f"{r} array<long>" for r in REFS)
S, C, E, G, P, A = "MaterialSampleRecord", "IdentifiedConcept", "SamplingEvent", "GeospatialCoordLocation", "SamplingSite", "Agent"


def row(i, pid, otype, n=None, label=None, **refs):
    return (i, pid, otype, n, label, None, None, None, None, *[refs.get(r[3:]) for r in REFS])


def frame(spark, rows, ints=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if ints:
        for r in REFS:
            df = df.withColumn(r, F.col(r).cast("array<int>"))
        df = df.withColumn("row_id", F.col("row_id").cast("int"))
    return df


def uris(df, pid, col):
    """The concepts of a sample, in order."""
    names = {r.row_id: r.pid for r in df.collect()}
    ids = df.filter(F.col("pid") == pid).first()[col]
    return None if ids is None else [names[i] for i in ids]


@pytest.fixture(scope="module")
def overlay(spark):
    ours = frame(spark, [row(102, "m/rock", C), row(103, "m/material", C), row(104, "m/mineral", C), row(1, "ark:1/k2", S, "OC", has_material_category=[102, 104, 103]), row(2, "ark:1/root", S, "OC", has_material_category=[103, 104]), row(3, "ark:1/order", S, "OC", has_material_category=[103, 102]), row(4, "igsn:N1", S, "OTHER", has_material_category=[103]), row(5, "ark:1/none", S, "OC", has_material_category=[103])])
    theirs = frame(spark, [row(9001, "m/new", C, label="New"), row(9002, "m/material", C), row(9003, "m/rock", C), row(9005, "m/mineral", C), row(1, "ark:1/k2", S, has_material_category=[9001]), row(2, "ark:1/root", S, has_material_category=[9002]), row(3, "ark:1/order", S, has_material_category=[9003, 9001, 9005]), row(4, "ark:1/newrecord", S, has_material_category=[9001]), row(5, "ark:1/none", S, has_material_category=[])], ints=True)
    cols = ["p__has_material_category"]
    return ours, theirs, sync.concept_overlay(ours, theirs, cols).cache(), cols


def test_their_concepts_win_in_order(overlay):
    ours, theirs, out, cols = overlay
    assert uris(out, "ark:1/k2", cols[0]) == ["m/new"] and uris(out, "ark:1/root", cols[0]) == ["m/material"]
    assert uris(out, "ark:1/order", cols[0]) == ["m/rock", "m/new", "m/mineral"]
    assert uris(out, "igsn:N1", cols[0]) == ["m/material"] and uris(out, "ark:1/none", cols[0]) is None
    assert out.filter("pid = 'ark:1/newrecord'").count() == 0
    new = out.filter("pid = 'm/new'").collect()
    assert len(new) == 1 and new[0].row_id == 105 and new[0].label == "New" and out.count() == ours.count() + 1


def test_the_overlay_validator_passes_and_bites(spark, overlay):
    ours, theirs, out, cols = overlay
    assert ck.failures(ck.overlay(ours, out, theirs, cols)) == []
    for change in (out.withColumn("n", F.lit("x")), out.filter("pid <> 'igsn:N1'"), out.withColumn(cols[0], F.reverse(cols[0])), out.withColumn(cols[0], F.when(F.col("pid") == "ark:1/k2", F.array(F.lit(7).cast("long"))).otherwise(F.col(cols[0])))):
        assert ck.failures(ck.overlay(ours, change, theirs, cols))


def test_bad_inputs_raise(spark, overlay):
    ours, theirs, _, cols = overlay
    with pytest.raises(sync.SyncError, match="repeated"):
        sync.concept_overlay(ours.union(ours.limit(1)), theirs, cols)
    with pytest.raises(sync.SyncError, match="unresolved"):
        sync.concept_overlay(ours, theirs.filter("pid <> 'm/new'"), cols)


def test_thumbnails(spark):
    wide = spark.createDataFrame([("a", "own"), ("b", None), ("c", None)], "pid string, thumbnail_url string")
    urls = spark.createDataFrame([("a", "z"), ("a", "y"), ("b", None), (None, "q")], "pid string, thumbnail_url string")
    assert sorted(tuple(r) for r in sync.overlay_column(wide, urls, "pid", "thumbnail_url").collect()) == [("a", "y"), ("b", None), ("c", None)][:0] + sorted([("a", "y"), ("b", None), ("c", None)])


def test_descriptions_of_one_source_only(spark):
    wide = spark.createDataFrame([("a", "OC", "old"), ("b", None, "old"), ("c", "X", "old")], "pid string, n string, description string")
    new = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "new")], "pid string, description string")
    got = {r.pid: r.description for r in sync.overlay_where(wide, new, "pid", "description", F.col("n") == "OC").collect()}
    assert got == {"a": "new", "b": "old", "c": "old"}


OURS = [
    row(1, "c/root", C), row(2, "c/rock", C), row(3, "c/artifact", C),
    row(1000, "pid-C", S, "OC", has_material_category=[1, 2], produced_by=[103]), row(1001, "pid-NON-OC", S, "OTHER", has_material_category=[2], produced_by=[104]),
    row(103, "ev-C", E, sample_location=[203], responsibility=[500]), row(104, "ev-N", E, sample_location=[204], responsibility=[501]),
    row(203, "geo-C", G), row(204, "geo-N", G), row(500, "agent-C", A), row(501, "agent-N", A),
]
THEIRS = [
    row(901, "c/root", C), row(902, "c/rock", C), row(903, "c/artifact", C), row(904, "c/earthsurface", C, label="Surface"),
    row(11, "pid-A", S, has_material_category=[902, 901], produced_by=[101], keywords=[904]), row(12, "pid-B", S, has_material_category=[903], produced_by=[102]),
    row(101, "ev-A", E, sample_location=[201]), row(102, "ev-B", E, sample_location=[202], sampling_site=[301]),
    row(201, "geo-A", G), row(202, "geo-B", G), row(211, "geo-S", G), row(301, "site-B", P, site_location=[211]),
]


def test_true_sync(spark):
    ours, theirs = frame(spark, OURS), frame(spark, THEIRS, ints=True)
    out = sync.true_sync(ours, theirs, "OC").cache()
    pids = {r.pid for r in out.collect()}
    assert not pids & {"pid-C", "ev-C", "geo-C", "agent-C"}
    assert {"pid-A", "pid-B", "ev-A", "ev-B", "geo-A", "geo-B", "geo-S", "site-B", "c/earthsurface", "pid-NON-OC", "ev-N", "geo-N", "agent-N"} <= pids
    assert uris(out, "pid-A", "p__has_material_category") == ["c/rock", "c/root"] and uris(out, "pid-A", "p__keywords") == ["c/earthsurface"]
    assert uris(out, "ev-B", "p__sampling_site") == ["site-B"] and uris(out, "site-B", "p__site_location") == ["geo-S"]
    top = max(r[0] for r in OURS)
    assert all(r.row_id > top for r in out.filter(F.col("pid").isin("pid-A", "ev-A", "geo-A", "c/earthsurface")).collect())
    assert out.filter("pid = 'pid-NON-OC'").exceptAll(ours).count() == 0
    assert {r.n for r in out.filter(F.col("pid").isin("pid-A", "pid-B")).collect()} == {"OC"}
    assert sync.dangling(out).count() == 0
    again = sync.true_sync(out, theirs, "OC")
    assert again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0


def test_shared_entities_stay(spark):
    rows = [r if r[0] != 1001 else row(1001, "pid-NON-OC", S, "OTHER", produced_by=[103]) for r in OURS if r[0] != 104]
    out = sync.true_sync(frame(spark, rows), frame(spark, THEIRS, ints=True), "OC")
    pids = {r.pid for r in out.collect()}
    assert {"ev-C", "geo-C", "agent-C"} <= pids and "pid-C" not in pids


def test_orphans_go_through_sites(spark):
    rows = [row(1, "s", S, "OC", produced_by=[2]), row(2, "e", E, sampling_site=[3], sample_location=[4]), row(3, "p", P, site_location=[4]), row(4, "g", G), row(5, "other", P, site_location=[6]), row(6, "g2", G), row(7, "c", C)]
    gone = sync.orphans(frame(spark, rows), spark.createDataFrame([("s",)], "pid string"))
    assert sorted(r.row_id for r in gone.collect()) == [1, 2, 3, 4]


def test_collisions_and_lost_references_raise(spark):
    ours, theirs = frame(spark, OURS), frame(spark, THEIRS, ints=True)
    with pytest.raises(sync.SyncError, match="another source"):
        sync.true_sync(ours.withColumn("pid", F.when(F.col("pid") == "pid-NON-OC", "pid-A").otherwise(F.col("pid"))), theirs, "OC")
    with pytest.raises(sync.SyncError, match="without a target"):
        sync.true_sync(ours, theirs.filter("pid <> 'geo-A'"), "OC")


def test_minted_ids_are_dense_and_repeatable(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).cast("string").alias("k"))
    a = {r.k: r.row_id for r in sync.mint(df, 10, "k").collect()}
    assert a == {r.k: r.row_id for r in sync.mint(df.repartition(7), 10, "k").collect()}
    assert [a[k] for k in sorted(a)] == list(range(11, 511))
    assert sync.mint(df.limit(0), 5, "k").count() == 0


def test_conform(spark):
    like = spark.createDataFrame([], "a long, b array<string>, c string")
    got = sync.conform(spark.createDataFrame([(1, "x")], "a int, extra string"), like)
    assert got.dtypes == like.dtypes and tuple(got.first()) == (1, None, None)


def test_narrow_and_wide_agree(spark):
    w = frame(spark, THEIRS)
    n = graph.to_narrow(w)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(graph.edges(n).select("s", "p", "o")) == rows(graph.wide_edges(w))
    for path in (graph.direct_path, graph.site_path):
        assert rows(path(w, graph.wide_edges(w))) == rows(path(n, graph.edges(n)))
    back = graph.to_wide(n, [r[3:] for r in REFS])
    assert rows(graph.wide_edges(back)) == rows(graph.wide_edges(w))
    assert {r.location_type for r in graph.classify_places(w, graph.wide_edges(w), keep_unused=True).collect()} == {"sample_location_only", "site_location_only"}
    assert [r.pid for r in graph.samples_at(w, graph.wide_edges(w), "geo-S", via_site=True).collect()] == ["pid-B"]
    assert [r.pid for r in graph.used_by(w, 211).collect()] == ["site-B"]
