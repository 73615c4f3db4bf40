"""Validation: every derived table against its definition.

A check is one row (check, passed, detail), so that all checks of a build are one
DataFrame.  Set comparisons are symmetric: rows that only one side has fail the
check whichever side it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import not_blank
from ..operators import facets, graph, hierarchy, quality, setops
from .build import DIMS, FLAT, Build

CENTRE_TOLERANCE = 1e-5
BUILT_TOGETHER = ("sample_facet_index", "sample_facet_index_meta", "facet_node_bits", "sample_facet_masks")


def result(name: str, bad: DataFrame) -> DataFrame:
    """Passed when ``bad`` has no rows; the detail is their number."""
    n = bad.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(name).alias("check"), (F.col("n") == 0).alias("passed"), F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("detail"))


def equal(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    return result(name, setops.symmetric_difference(a, b))


def holds(name: str, df: DataFrame, condition: Column) -> DataFrame:
    return result(name, df.filter(~F.coalesce(condition, F.lit(False))))


def unique(name: str, df: DataFrame, *keys: str) -> DataFrame:
    return result(name, quality.duplicates(df, *keys).unionByName(df.filter(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1).select(*keys, F.lit(1).cast("long").alias("n"))))


def schema(name: str, df: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    ok = list(df.dtypes) == list(expected)
    return df.sparkSession.createDataFrame([(name, ok, "" if ok else f"found {df.dtypes}")], "check string, passed boolean, detail string")


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def flat(tables: dict[str, DataFrame], roots: dict[str, str]) -> DataFrame:
    """Facets, map, summaries, cube and clusters agree with one another."""
    return _all([flat_pids(tables, roots), flat_summaries(tables), flat_cube(tables), *flat_cells(tables)])


def flat_pids(tables: dict[str, DataFrame], roots: dict[str, str]) -> DataFrame:
    f, lite = tables["sample_facets_v2"], tables["samples_map_lite"]
    root_rows = F.lit(False)
    for d, uri in roots.items():
        root_rows = root_rows | F.coalesce(F.col(d) == uri, F.lit(False))
    out = result("no root as a facet value", f.filter(root_rows))
    out = out.union(unique("facet pids", f, "pid")).union(unique("map pids", lite, "pid"))
    return out.union(equal("facets and map have the same pids", f.select("pid"), lite.select("pid")))


def flat_summaries(tables: dict[str, DataFrame]) -> DataFrame:
    s = tables["facet_summaries"]
    out = equal("summaries", s.select("facet_type", "facet_value", "count"), facets.summaries(tables["sample_facets_v2"], FLAT).select("facet_type", "facet_value", "count"))
    return out.union(holds("summaries have no scheme and no blanks", s, F.col("scheme").isNull() & not_blank(F.col("facet_value"))))


def flat_cube(tables: dict[str, DataFrame]) -> DataFrame:
    x, s = tables["facet_cross_filter"], tables["facet_summaries"]
    out = unique_pairs("cube grain", x).union(equal("cube", x, facets.cross_filter(tables["sample_facets_v2"], FLAT).select(*x.columns)))
    return out.union(equal("cube baseline", facets.cube_slice(x, None, None), s.select("facet_type", "facet_value", "count")))


def flat_cells(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """A check for each cluster table."""
    lite, out = tables["samples_map_lite"], []
    for name, df in tables.items():
        if name.startswith("h3_summary_res"):
            total = df.agg(F.coalesce(F.sum("sample_count"), F.lit(0)).alias("a")).crossJoin(lite.filter(F.col(name.replace("_summary", "")).isNotNull()).agg(F.count(F.lit(1)).alias("b")))
            out.append(holds(f"{name} counts all", total, F.col("a") == F.col("b")))
    return out


def unique_pairs(name: str, cube: DataFrame) -> DataFrame:
    """A cube has one row for each filter and value (set comparison would hide repeats)."""
    keys = [c for c in cube.columns if c != "count"]
    return result(name, quality.duplicates(cube, *keys))


def centres(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Cluster tables agree: figures exactly, centres within a tolerance."""
    j = setops.compare(a, b, "h3_cell", "sample_count", "source_count", "dominant_source").select("h3_cell")
    c = a.alias("a").join(b.alias("b"), "h3_cell").filter(F.greatest(F.abs(F.col("a.center_lat") - F.col("b.center_lat")), F.abs(F.col("a.center_lng") - F.col("b.center_lng"))) > CENTRE_TOLERANCE).select("h3_cell")
    return result(name, j.union(c))


def rebuilt(tables: dict[str, DataFrame], build: Build) -> DataFrame:
    """The semantic gate: every table equals what its definition gives from the graph."""
    out: DataFrame | None = None
    for name, df in tables.items():
        fresh = build.table(name)
        one = centres(f"{name} rebuilt", df, fresh) if name.startswith("h3_summary") else equal(f"{name} rebuilt", df, fresh.select(*df.columns))
        out = one if out is None else out.union(one)
    return out


def tree(tables: dict[str, DataFrame], roots: dict[str, str]) -> DataFrame:
    """Tree counts, membership and the tree cube agree with one another."""
    return _all([tree_shape(tables, roots), tree_members(tables), tree_cube(tables)])


def tree_shape(tables: dict[str, DataFrame], roots: dict[str, str]) -> DataFrame:
    """Parents hold at least their children, every parent exists, one root a dimension."""
    t = tables["facet_tree_summaries"]
    up = t.select("facet_type", F.col("concept_uri").alias("parent_uri"), F.col("count").alias("above"))
    out = result("parents count at least their children", t.join(up, ["facet_type", "parent_uri"]).filter(F.col("count") > F.col("above")))
    out = out.union(result("parents exist", t.filter(F.col("parent_uri").isNotNull()).join(up, ["facet_type", "parent_uri"], "left_anti")))
    r = t.filter(F.col("parent_uri").isNull()).groupBy("facet_type").agg(F.count(F.lit(1)).alias("n"), F.first("concept_uri").alias("root"))
    wanted = t.sparkSession.createDataFrame(list(roots.items()), "facet_type string, want string")
    return out.union(holds("one root in each dimension", wanted.join(r, "facet_type", "left"), (F.col("n") == 1) & (F.col("root") == F.col("want"))))


def tree_members(tables: dict[str, DataFrame]) -> DataFrame:
    t, m = tables["facet_tree_summaries"], tables["sample_facet_membership"]
    n = m.groupBy("facet_type", "concept_uri").agg(F.count_distinct("pid").alias("count"))
    return unique("membership grain", m, "pid", "facet_type", "concept_uri").union(equal("tree counts", t.select("facet_type", "concept_uri", "count"), n))


def tree_cube(tables: dict[str, DataFrame]) -> DataFrame:
    t, m, x = tables["facet_tree_summaries"], tables["sample_facet_membership"], tables["facet_tree_cross_filter"]
    same = F.lit(False)
    for d in ("source", *DIMS):
        same = same | (F.col(f"filter_{d}").isNotNull() & (F.col("facet_type") == d))
    out = unique_pairs("tree cube grain", x).union(result("tree cube has no filter on its own dimension", x.filter(same)))
    base = facets.cube_slice(x, None, None).filter(F.col("facet_type") != "source")
    out = out.union(equal("tree cube baseline", base, t.select("facet_type", F.col("concept_uri").alias("facet_value"), "count")))
    return out.union(equal("tree cube", x, facets.tree_cross_filter(m, tables["sample_facets_v2"], DIMS).select(*x.columns)))


def masks(tables: dict[str, DataFrame]) -> DataFrame:
    """Bits are dense and fit, masks are their OR, and a mask filter equals the membership filter."""
    b, k, m = tables["facet_node_bits"], tables["sample_facet_masks"], tables["sample_facet_membership"]
    d = b.groupBy("facet_type").agg(F.min("bit_index").alias("lo"), F.max("bit_index").alias("hi"), F.count_distinct("bit_index").alias("n"), F.count(F.lit(1)).alias("rows"))
    out = holds("bits are dense and at most 62", d, (F.col("lo") == 0) & (F.col("hi") <= 62) & (F.col("n") == F.col("hi") + 1) & (F.col("rows") == F.col("n")))
    out = out.union(equal("bits cover the nodes", b.select("facet_type", "concept_uri"), m.select("facet_type", "concept_uri").distinct()))
    out = out.union(unique("mask pids", k, "pid"))
    ids = b.select("build_id").union(k.select("build_id")).agg(F.count_distinct("build_id").alias("n"))
    out = out.union(holds("bits and masks are of one build", ids, F.col("n") == 1))
    cols = ["pid", *[f"{x}_mask" for x in DIMS]]
    out = out.union(equal("masks", k.select(*cols), hierarchy.masks(m, b, DIMS).select(*cols)))
    for dim in DIMS:
        one = b.filter((F.col("facet_type") == dim)).agg(F.max_by("concept_uri", "bit_index").alias("concept_uri"), F.max("bit_index").alias("bit_index"))
        by_mask = k.crossJoin(F.broadcast(one)).filter(F.getbit(F.col(f"{dim}_mask"), F.col("bit_index")) == 1).select("pid")
        by_rows = m.filter(F.col("facet_type") == dim).join(F.broadcast(one.select("concept_uri")), "concept_uri", "left_semi").select("pid")
        out = out.union(equal(f"{dim}: mask filter and membership filter", by_mask, by_rows))
    return out


INDEX_SCHEMA = [("pid", "string"), ("source", "string"), *[(f"{d}_mask", "bigint") for d in DIMS], ("build_id", "string"), ("schema_version", "int")]


def index(tables: dict[str, DataFrame]) -> DataFrame:
    """The index is complete, tells sources and masks as the tables do, and is of one build; so is what is told of it."""
    return _all([index_rows(tables), *([index_meta(tables)] if tables.get("sample_facet_index_meta") is not None else [])])


def index_rows(tables: dict[str, DataFrame]) -> DataFrame:
    i, lite, k, f = tables["sample_facet_index"], tables["samples_map_lite"], tables["sample_facet_masks"], tables["sample_facets_v2"]
    cols = [f"{d}_mask" for d in DIMS]
    out = schema("index schema", i, INDEX_SCHEMA)
    present = F.col("pid").isNotNull() & F.col("build_id").isNotNull() & F.col("schema_version").isNotNull()
    for c in cols:
        present = present & F.col(c).isNotNull()
    out = out.union(holds("index has no nulls", i, present)).union(unique("index pids", i, "pid"))
    out = out.union(equal("index is complete", i.select("pid"), lite.select("pid")))
    out = out.union(result("index sources", setops.compare(i, f, "pid", "source")))
    out = out.union(holds("index version", i, F.col("schema_version") == hierarchy.SCHEMA_VERSION))
    out = out.union(holds("index build id has two halves", i.select("build_id").distinct(), F.col("build_id").rlike("^[0-9a-f]+:.+$")))
    again = hierarchy.build_ids(tables["sample_facet_membership"], lite).select("build_id")
    out = out.union(equal("index build id", i.select("build_id").distinct(), again))
    want = i.select("pid").join(k.select("pid", *cols), "pid", "left").na.fill(0, cols)
    return out.union(equal("index masks", i.select("pid", *cols), want))


def index_meta(tables: dict[str, DataFrame]) -> DataFrame:
    i, meta = tables["sample_facet_index"], tables["sample_facet_index_meta"]
    n = i.filter(not_blank(F.col("source"))).groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    out = equal("index meta", meta.select("source", "count"), n)
    rows = meta.select("total_rows").distinct().crossJoin(i.agg(F.count(F.lit(1)).alias("n")))
    out = out.union(holds("index meta total", rows, F.col("total_rows") == F.col("n")))
    s = tables["facet_summaries"].filter(F.col("facet_type") == "source").select(F.col("facet_value").alias("source"), "count")
    return out.union(equal("index meta and summaries", meta.select("source", "count"), s))


def overlay(before: DataFrame, after: DataFrame, theirs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """An overlay changed the lists it should, in order, and nothing else."""
    sample, concept = "MaterialSampleRecord", "IdentifiedConcept"
    out = unique("overlay ids", after, "row_id")
    out = out.union(equal("overlay keeps the samples", graph.of_type(before, sample).select("pid"), graph.of_type(after, sample).select("pid")))
    rest = [c for c in before.columns if c not in columns]
    print_ = lambda df: df.select("row_id", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit(chr(0))) for c in rest]).alias("h"))
    old = print_(before)
    out = out.union(result("overlay leaves other columns", old.join(print_(after), ["row_id", "h"], "left_anti")))
    both = graph.of_type(theirs, sample).select("pid").join(graph.of_type(before, sample).select("pid"), "pid", "left_semi")
    for c in columns:
        uris = lambda df, c=c: (
            graph.of_type(df, sample).join(both, "pid", "left_semi").select("pid", F.posexplode(F.col(c).cast("array<bigint>")).alias("pos", "id")).join(graph.of_type(df, concept).select(F.col("row_id").cast("long").alias("id"), F.col("pid").alias("uri")), "id").groupBy("pid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "uri"))), lambda z: z["uri"]).alias("uris"))
        )
        out = out.union(result(f"{c}: lists equal theirs", setops.compare(uris(theirs), uris(after), "pid", "uris")))
        apart = lambda df, c=c: graph.of_type(df, sample).join(both, "pid", "left_anti").select("pid", F.col(c).cast("array<bigint>").alias(c))
        out = out.union(result(f"{c}: other samples unchanged", setops.compare(apart(before), apart(after), "pid", c)))
    dangling = graph.wide_edges(after, [c[len(graph.PREFIX) :] for c in columns]).join(after.select(F.col("row_id").cast("long").alias("o")), "o", "left_anti")
    minted = after.join(before.select("row_id"), "row_id", "left_anti").filter(F.col("otype") != concept)
    return out.union(result("no dangling references", dangling)).union(result("only concepts are minted", minted))


def lite_against(lite: DataFrame, summaries: dict[int, DataFrame]) -> DataFrame:
    """Cells of a map table, counted, against shipped summaries, both ways (full outer)."""
    out: DataFrame | None = None
    for r, s in summaries.items():
        n = lite.groupBy(F.col(f"h3_res{r}").alias("h3_cell")).agg(F.count(F.lit(1)).cast("int").alias("sample_count")).filter("h3_cell is not null")
        one = result(f"cells at resolution {r}", setops.compare(n, s.select("h3_cell", "sample_count"), "h3_cell", "sample_count"))
        out = one if out is None else out.union(one)
    return out


def everything(tables: dict[str, DataFrame], build: Build) -> list[DataFrame]:
    """All checks, in groups that are planned one at a time."""
    groups = [flat(tables, build.roots), tree(tables, build.roots), masks(tables), index(tables)]
    return groups + [rebuilt({name: df}, build) for name, df in tables.items() if name not in BUILT_TOGETHER]


def failures(*checks: DataFrame) -> list[tuple[str, str]]:
    """(check, detail) of what failed: a handful of rows."""
    return [(r.check, r.detail) for c in checks for r in c.filter(~F.col("passed")).collect()]
