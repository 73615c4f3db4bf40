"""The build on small graphs with counts known by hand, and validators that must bite."""

import pytest
from pyspark.sql import functions as F

from corelode.functions import geo
from corelode.lineage import checkpointed
from corelode.operators import facets, hierarchy
from corelode.operators.filters import FilterState
from corelode.plans import build as bd
from corelode.plans import checks as ck
from corelode.sources import sinks

V = "https://example.org/vocabulary/"
MAT, CTX, OBJ = V + "material/", V + "feature/", V + "objecttype/"
ROOTS = {"material": MAT + "material", "context": CTX + "anyfeature", "object_type": OBJ + "sample"}
SCHEMA = "otype string, pid string, row_id long, n string, label string, description string, place_name array<string>, result_time string, geometry binary, p__has_material_category array<long>, p__has_context_category array<long>, p__has_sample_object_type array<long>, p__keywords array<long>, p__produced_by array<long>, p__sampling_site array<long>"
CONCEPTS = [(1, MAT + "material"), (2, MAT + "mineral"), (3, MAT + "rock"), (4, MAT + "metal"), (10, CTX + "anyfeature"), (11, CTX + "earthinterior"), (20, OBJ + "sample"), (21, OBJ + "solid")]
VOCAB = [(MAT + "mineral", MAT + "material"), (MAT + "rock", MAT + "material"), (MAT + "metal", MAT + "material"), (MAT + "material", None), (CTX + "earthinterior", CTX + "anyfeature"), (CTX + "anyfeature", None), (OBJ + "solid", OBJ + "sample"), (OBJ + "sample", None), (V + "lost", V + "nowhere")]


def concept(i, uri):
    return ("IdentifiedConcept", uri, i, None, uri.rsplit("/", 1)[-1], None, None, None, None, None, None, None, None, None, None)


def sample(i, pid, material, source="TEST", located=True, place=("plc",), time=None, event=None, ctx=(11,), obj=(21,), keywords=None):
    lists = lambda x: None if x is None else list(x)
    return ("MaterialSampleRecord", pid, i, source, f"label {pid}", f"text of {pid}", lists(place), time, geo.encode_point(10.0 + i % 10, 40.0 + i % 10) if located else None, lists(material), lists(ctx), lists(obj), lists(keywords), lists(event), None)


def event(i, time, site=None):
    return ("SamplingEvent", f"ev{i}", i, None, None, None, None, time, None, None, None, None, None, None, site)


def site(i, place):
    return ("SamplingSite", f"site{i}", i, None, None, None, place, None, None, None, None, None, None, None, None)


def make(spark, rows):
    wide = spark.createDataFrame([*[concept(*c) for c in CONCEPTS], *rows], SCHEMA)
    return bd.Build(wide, spark.createDataFrame(VOCAB, "uri string, broader string"), ROOTS)


@pytest.fixture(scope="module")
def flat(spark):
    rows = [sample(1000, "broad-then-real", [1, 2, 3]), sample(1001, "real-then-broad", [4, 1]), sample(1002, "broad-alone", [1]), sample(1003, "no-list", None), sample(1004, "lost-id", [999]), sample(1005, "unplaced", [4], located=False)]
    return make(spark, rows)


def test_first_real_concept(flat):
    got = {r.pid: r.material for r in flat.samp.collect()}
    assert got == {"broad-then-real": MAT + "mineral", "real-then-broad": MAT + "metal", "broad-alone": None, "no-list": None, "lost-id": None, "unplaced": MAT + "metal"}
    assert flat.table("sample_facets_v2").filter("pid = 'unplaced'").count() == 0
    assert flat.table("samples_map_lite").count() == 5


def test_walk_to_event_and_site(spark):
    rows = [sample(301, "t-full", [2], place=None, event=[100]), sample(302, "t-event-only", [2], place=None, event=[101]), sample(303, "t-no-event", [2], place=None), sample(304, "t-empty-direct", [2], place=(), time="", event=[102])]
    rows += [event(100, "2020-06-15", [200]), event(101, "2021-03-01"), event(102, "2022-11-20", [201]), site(200, ["Full Chain Site"]), site(201, ["Fallthrough Site"])]
    got = {r.pid: (r.result_time, r.place_name) for r in make(spark, rows).samp.collect()}
    assert got == {"t-full": ("2020-06-15", ["Full Chain Site"]), "t-event-only": ("2021-03-01", None), "t-no-event": (None, None), "t-empty-direct": ("2022-11-20", ["Fallthrough Site"])}


@pytest.fixture(scope="module")
def tree(spark):
    return make(spark, [sample(301, "s1", [2], "A"), sample(302, "s2", [3], "A"), sample(303, "s3", [2], "B"), sample(304, "s-nomem", [1], "C", ctx=None, obj=None)])


def test_tree_counts_and_cube(tree):
    counts = {(r.facet_type, r.concept_uri): r["count"] for r in tree.table("facet_tree_summaries").collect()}
    assert counts[("material", MAT + "mineral")] == 2 and counts[("material", MAT + "material")] == 3 and counts[("context", CTX + "anyfeature")] == 3
    cube = tree.table("facet_tree_cross_filter")
    under = {(r.facet_type, r.facet_value): r["count"] for r in facets.cube_slice(cube, "material", MAT + "mineral").collect()}
    assert under[("context", CTX + "earthinterior")] == 2 and under[("source", "A")] == 1 and under[("source", "B")] == 1
    assert not any(t == "material" for t, _ in under)
    a = {(r.facet_type, r.facet_value): r["count"] for r in facets.cube_slice(cube, "source", "A").collect()}
    assert a[("material", MAT + "mineral")] == a[("material", MAT + "rock")] == 1 and a[("material", MAT + "material")] == 2


def test_index_holds_samples_without_nodes(tree):
    rows = {r.pid: r for r in tree.table("sample_facet_index").collect()}
    assert len(rows) == 4 and tree.table("sample_facet_masks").count() == 3
    r = rows["s-nomem"]
    assert (r.material_mask, r.context_mask, r.object_type_mask) == (0, 0, 0)
    bits_id = tree.table("facet_node_bits").first().build_id
    assert r.build_id.split(":")[0] == bits_id


def test_unreachable_concepts_are_reported(tree):
    assert [r.uri for r in tree.unreachable().collect()] == [V + "lost"]


def test_keywords_and_labels(spark):
    b = make(spark, [sample(301, "k", [3, 2], keywords=[4])])
    assert b.samp.first().concept_labels == "earthinterior metal mineral rock solid"


def test_bad_input_and_cycles_raise(spark):
    with pytest.raises(ValueError, match="pid"):
        make(spark, [sample(101, "x", [2]), sample(102, "x", [2])]).check_input()
    with pytest.raises(ValueError, match="row_id"):
        make(spark, [sample(101, "x", [2]), sample(101, "y", [2])]).check_input()
    with pytest.raises(ValueError, match="cycle"):
        bd.Build(None, spark.createDataFrame([("a", "b"), ("b", "a")], "uri string, broader string"), ROOTS).tree  # noqa: B018


def test_closure_both_ways(spark):
    t = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "uri string, parent_uri string")
    rows = lambda df: sorted((r.uri, r.ancestor_uri, r.distance) for r in df.collect())
    plain = t.filter("uri < 'x'")
    assert rows(hierarchy.closure(plain)) == rows(hierarchy.closure(plain, max_local=0))
    assert ("x", "y", 1) in rows(hierarchy.closure(t))
    assert sorted(r.uri for r in hierarchy.check_tree(t).collect()) == ["x", "y"]


def test_too_many_nodes(spark):
    many = spark.range(64).select(F.lit("d").alias("facet_type"), F.col("id").cast("string").alias("concept_uri"))
    with pytest.raises(ValueError, match="64"):
        hierarchy.check_bits(hierarchy.node_bits(many))


def tables_of(b):
    return {n: checkpointed(b.table(n)) for n in bd.NEEDS if n != "wide_h3"}


def test_all_checks_pass_and_bite(tree):
    t = tables_of(tree)
    assert ck.failures(*ck.everything(t, tree)) == []
    changed = {
        "facet_summaries": lambda d: d.withColumn("count", F.when(F.col("facet_value") == "A", 9).otherwise(F.col("count")).cast("long")),
        "facet_cross_filter": lambda d: d.union(d.limit(1)),
        "sample_facets_v2": lambda d: d.filter("pid <> 's1'"),
        "h3_summary_res4": lambda d: d.withColumn("center_lat", F.col("center_lat") + 0.1),
        "facet_tree_summaries": lambda d: d.withColumn("count", F.when(F.col("parent_uri").isNull(), F.lit(0)).otherwise(F.col("count")).cast("long")),
        "facet_tree_cross_filter": lambda d: d.filter("filter_source is null"),
        "sample_facet_membership": lambda d: d.limit(3),
        "facet_node_bits": lambda d: d.withColumn("bit_index", F.col("bit_index") + 1),
        "sample_facet_masks": lambda d: d.withColumn("material_mask", F.lit(0).cast("long")),
        "sample_facet_index": lambda d: d.withColumn("build_id", F.lit("0:0")),
        "sample_facet_index_meta": lambda d: d.withColumn("total_rows", F.lit(1).cast("long")),
    }
    for name, change in changed.items():
        bad = t | {name: change(t[name])}
        one = {"sample_facet_index": ck.index, "sample_facet_index_meta": ck.index, "facet_node_bits": ck.masks, "sample_facet_masks": ck.masks}.get(name)
        found = [one(bad)] if one else [ck.tree(bad, ROOTS)] if "tree" in name or "membership" in name else [ck.flat(bad, ROOTS), ck.rebuilt({name: bad[name]}, tree)]
        assert ck.failures(*found), name


def test_every_tier_gives_the_same_counts(spark, tree):
    g = tree.samp_geo
    bits = tree.bits.persist()
    numbers = {(r.facet_type, r.concept_uri): r.bit_index for r in bits.collect()}
    index = hierarchy.index(g, hierarchy.masks(tree.member, bits, bd.DIMS), bd.DIMS)
    cube = facets.tree_cross_filter(tree.member, g, bd.DIMS)
    t = facets.Tables(g, tree.member, bits, index, cube, None, ("A", "B", "C"), bd.DIMS, "pid", numbers)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    one = FilterState(nodes={"material": frozenset({MAT + "mineral"})})
    two = FilterState(sources=frozenset({"A"}), nodes={"material": frozenset({MAT + "mineral"}), "context": frozenset({CTX + "earthinterior"})})
    boxed = FilterState(nodes=one.nodes, bbox=geo.BBox(40, 10, 41.5, 12))
    for state, tier in ((FilterState(), "baseline"), (one, "tree_cube"), (FilterState(sources=frozenset({"A"})), "tree_cube"), (two, "index"), (boxed, "index")):
        name, got = facets.route(t, state, global_view=state.bbox is None)
        assert name == tier
        assert rows(got) == rows(facets.slow_counts(t, state)) == rows(facets.index_counts(t, state))
    lost = FilterState(nodes={"material": frozenset({"unknown"})})
    assert facets.route(t, lost)[0] in ("tree_cube", "slow")
    none = facets.index_counts(t, FilterState(sources=frozenset()))
    assert {r.facet_type for r in none.collect()} == {"source"}


def test_selection_forces_what_is_needed():
    assert bd.selection(["sample_facet_index"]) == ["sample_facet_membership", "facet_node_bits", "sample_facet_index"]
    assert bd.selection(["sample_facet_index_meta"]) == ["sample_facet_index_meta"]
    assert "wide_h3" not in bd.selection(skip=["wide_h3"])
    with pytest.raises(ValueError, match="nonsense"):
        bd.selection(["nonsense"])


def test_write_manifest_and_release(spark, tree, tmp_path):
    out = str(tmp_path / "derived")
    names = tree.write(out, ["facet_summaries", "sample_facets_v2"])
    paths = {n: f"{out}/{n}.parquet" for n in names}
    m = sinks.manifest(spark, {}, paths, ["build"])
    assert m["outputs"]["sample_facets_v2"]["rows"] == 4
    assert sinks.verify_manifest(m, out) == []
    sinks.write(spark.range(3), paths["facet_summaries"])
    assert sinks.verify_manifest(m, out) == ["facet_summaries: changed"]
    assert set(sinks.release_manifest(out, ["facet_summaries.parquet"], {"base": 1, "hot": 2, "total": 3})["files"]) == {"facet_summaries.parquet"}
    with pytest.raises(ValueError):
        sinks.release_manifest(out, [], {"base": 1, "hot": 2, "total": 4})
    with pytest.raises(FileNotFoundError):
        sinks.release_manifest(out, ["none"], {})


def test_cells_derived_anew(tree):
    lite = tree.table("samples_map_lite")
    again = bd.add_cells(lite.drop("h3_res4", "h3_res6", "h3_res8"))
    shipped = {r: tree.table(f"h3_summary_res{r}") for r in bd.RESOLUTIONS}
    assert ck.failures(ck.lite_against(again, shipped)) == []
    assert ck.failures(ck.lite_against(again.limit(2), shipped))
