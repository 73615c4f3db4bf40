"""What the build and its checks must keep to so that they grow with their input only."""

from pyspark.sql import functions as F

from corelode import lineage
from corelode.operators import facets, setops
from corelode.plans import build as bd
from corelode.plans import catalogue_build as cb

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_difference_reads_each_side_once(spark):
    a, b = spark.range(5).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("v")), spark.range(2, 8).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    both = setops.symmetric_difference(a.union(a), b)
    assert _plan(setops.symmetric_difference(a, b)).count("Range (") == 2
    got = sorted(both.collect(), key=str)
    assert {(r.k, r.side) for r in got} == {(None, "left"), (1, "left"), (5, "right"), (6, "right"), (7, "right")} and len(got) == 5


def test_a_cube_counts_equal_rows_before_it_pairs_values(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", " ")], "s string, m string")
    cube = facets.cross_filter(rows, ["s", "m"])
    plan = _plan(cube)
    assert plan.rindex("Aggregate") > plan.rindex("Generate")
    got = {(r.filter_s, r.filter_m, r.facet_type, r.facet_value): r["count"] for r in cube.collect()}
    assert got == {(None, None, "s", "a"): 3, (None, None, "s", "b"): 1, (None, None, "m", "x"): 2, ("a", None, "s", "a"): 3, ("a", None, "m", "x"): 2, ("b", None, "s", "b"): 1, (None, "x", "s", "a"): 2, (None, "x", "m", "x"): 2}


def test_base_tables_are_made_once_and_checks_make_what_they_read(spark, monkeypatch):
    tags = []
    store = lineage.store
    monkeypatch.setattr(lineage, "store", lambda df, tag, *by: (tags.append(tag), store(df, tag, *by))[1])
    monkeypatch.setattr(lineage, "_kept", {})
    assert cb.val_summaries(spark, SMALL).count() == 2
    assert {t for t in tags if t.startswith("built-")} == {"built-facet_summaries"} and "base-member" not in tags
    assert cb.val_index_meta(spark, SMALL).count() == 3 and cb.val_membership(spark, SMALL).count() == 2
    assert {t for t in tags if t.startswith("built-")} == {"built-facet_summaries", "built-sample_facet_index", "built-sample_facet_index_meta", "built-facet_tree_summaries"}
    assert all(tags.count(t) == 1 for t in ("base-samp_geo", "base-member", "base-bits", "base-ids", "base-tree", "graph"))


def test_first_concepts_come_of_one_pass_over_the_samples(spark):
    wide = spark.read.parquet(lineage.store(cb._graph(spark, SMALL), "wide")).withColumn("row_id", F.col("row_id"))
    b = bd.Build(wide, cb._vocabulary(spark, SMALL), cb.ROOTS)
    plan = _plan(b._first_real())
    assert plan.count("Generate") == 1 and plan.count("Aggregate") == 1
