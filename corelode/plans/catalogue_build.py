"""Queries over a graph with vocabulary and geometry: its build, the checks of it, overlays and synchronisation.

The graph is made of the driver's tables once: orders are samples, customers their
events, regions sites; priorities, nations and order statuses are concepts under
three roots.  The checks are run on tables with planted faults, whose number the SQL
works out from the same tables.
"""

from __future__ import annotations

import dataclasses

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import arrays as ar
from ..functions import geo
from ..functions import text as tx
from ..lineage import forget_at_exit, fresh, kept, local, made_once
from ..operators import clusters, facets, graph, hierarchy, search, setops, sync, views
from ..operators import filters as fl
from ..sources import sinks, tables
from . import catalogue as base
from . import checks
from .build import DIMS, FLAT, Build, geocodes
from .catalogue import SAMPLES, _sources, _t, query

S, E, P, C = 1_000_000_000, 2_000_000_000, 4_000_000_000, 6_000_000_000
ROOTS = {"material": "m:root", "context": "c:root", "object_type": "t:root"}


def _concepts(spark, sf):
    """(row_id, pid, label, broader)."""
    r, n, o = _t(spark, sf, "region"), _t(spark, sf, "nation"), _t(spark, sf, "orders")
    top = local(spark, [(C, "m:root", "Any material", None), (C + 1, "c:root", "Anywhere", None), (C + 2, "t:root", None, None)], row_id=pa.int64(), pid=pa.string(), label=pa.string(), broader=pa.string())
    m = o.select("o_orderpriority").distinct().select((F.lit(C + 100) + F.substring("o_orderpriority", 1, 1).cast("long")).alias("row_id"), F.concat(F.lit("m:"), "o_orderpriority"), F.col("o_orderpriority"), F.lit("m:root"))
    a = r.select((F.lit(C + 200) + F.col("r_regionkey")).alias("row_id"), F.concat(F.lit("c:r:"), "r_name"), F.initcap("r_name"), F.lit("c:root"))
    b = n.join(r, n.n_regionkey == r.r_regionkey).select((F.lit(C + 300) + F.col("n_nationkey")).alias("row_id"), F.concat(F.lit("c:n:"), "n_name"), F.initcap("n_name"), F.concat(F.lit("c:r:"), "r_name"))
    t = local(spark, [(C + 400 + k, f"t:{x}", None if x == "P" else f"status {x}", "t:root") for k, x in enumerate("FOP")], row_id=pa.int64(), pid=pa.string(), label=pa.string(), broader=pa.string())
    return top.union(m).union(a).union(b).union(t)


def _vocabulary(spark, sf):
    return _concepts(spark, sf).select(F.col("pid").alias("uri"), "broader")


def _graph(spark, sf):
    def build():
        o, c, n, r = (_t(spark, sf, x) for x in ("orders", "customer", "nation", "region"))
        k = F.col("o_orderkey")
        blobs = local(spark, [(i, geo.encode_point(i * 7.0 - 80, i * 3.0 - 30)) for i in range(25)], n_nationkey=pa.int64(), geometry=pa.binary())
        rows = o.join(c, o.o_custkey == c.c_custkey).join(n.join(blobs, "n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"))
        ref = lambda x: F.array(x.cast("long"))
        prio, root = F.lit(C + 100) + F.substring("o_orderpriority", 1, 1).cast("long"), F.lit(C).cast("long")
        material = F.when(k % 4 == 0, F.array(root, prio)).when(k % 4 == 1, F.array(F.lit(999).cast("long"), prio, root)).when(k % 4 == 2, F.array(root))
        status = F.lit(C + 400) + F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
        none = lambda kind: F.lit(None).cast(kind)
        ids = "array<bigint>"
        s = rows.select(
            (k + S).alias("row_id"), F.concat(F.lit("o"), k.cast("string")).alias("pid"), F.lit("MaterialSampleRecord").alias("otype"), F.col("c_mktsegment").alias("n"), F.col("c_name").alias("label"), F.concat("n_name", F.lit(" "), "o_orderpriority").alias("description"),
            F.when(k % 3 == 0, F.array("n_name")).when(k % 3 == 1, F.array().cast("array<string>")).alias("place_name"), F.when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("")).alias("result_time"), F.when(F.col("c_nationkey") % 5 != 0, F.col("geometry")).alias("geometry"),
            material.alias("p__has_material_category"), ref(F.lit(C + 300) + F.col("c_nationkey")).alias("p__has_context_category"), ref(status).alias("p__has_sample_object_type"), F.when(k % 8 == 0, ref(prio)).alias("p__keywords"), ref(F.col("o_custkey") + E).alias("p__produced_by"), none(ids).alias("p__sampling_site"),
        )
        blank = [none(ids)] * 4
        ev = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey") + E, F.concat(F.lit("e"), F.col("c_custkey").cast("string")), F.lit("SamplingEvent"), none("string"), none("string"), none("string"), none("array<string>"), F.format_string("2000-01-%02d", F.col("c_custkey") % 28 + 1), none("binary"), *blank, none(ids), ref(F.col("n_regionkey") + P))
        st = r.select(F.col("r_regionkey") + P, F.concat(F.lit("s"), F.col("r_regionkey").cast("string")), F.lit("SamplingSite"), none("string"), none("string"), none("string"), F.array("r_name"), none("string"), none("binary"), *blank, none(ids), none(ids))
        co = _concepts(spark, sf).select("row_id", "pid", F.lit("IdentifiedConcept"), none("string"), "label", none("string"), none("array<string>"), none("string"), none("binary"), *blank, none(ids), none(ids))
        return s.union(ev).union(st).union(co)

    return kept(spark, _sources(sf, "orders", "customer", "nation", "region"), "graph", build)


def _build(spark, sf, alone=False):
    """The build; its base tables are written once for the application, unless it is to stand ``alone``."""
    sources = _sources(sf, "orders", "customer", "nation", "region")
    keep = None if alone else lambda name, make: kept(spark, sources, f"base-{name}", make)
    return Build(_graph(spark, sf), kept(spark, sources, "vocabulary", lambda: _vocabulary(spark, sf)), ROOTS, keep=keep)


SELECTIONS = ("sample_facets_v2", "samples_map_lite", "sample_facet_membership")  # columns of base tables, which are written


def _table(spark, sf, name):
    if name in SELECTIONS:
        return _build(spark, sf).table(name)
    return kept(spark, _sources(sf, "orders", "customer", "nation", "region"), f"built-{name}", lambda: _build(spark, sf).table(name))


BASE = """every AS (SELECT o_orderkey AS k, concat('o', CAST(o_orderkey AS VARCHAR)) AS pid, c_mktsegment AS source,
    CASE WHEN o_orderkey % 4 IN (0, 1) THEN concat('m:', o_orderpriority) END AS material, concat('c:n:', n_name) AS context, concat('t:', o_orderstatus) AS object_type,
    c_name AS label, concat(n_name, ' ', o_orderpriority) AS description, CASE WHEN o_orderkey % 3 = 0 THEN n_name ELSE r_name END AS place,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE printf('2000-01-%02d', CAST(o_custkey % 28 + 1 AS INTEGER)) END AS result_time,
    CAST(n_nationkey * 3 - 30 AS DOUBLE) AS latitude, CAST(n_nationkey * 7 - 80 AS DOUBLE) AS longitude, n_nationkey, r_name, o_orderpriority, o_orderstatus, n_name, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
samples AS (SELECT * FROM every WHERE n_nationkey % 5 <> 0),
mem AS (SELECT pid, 'material' AS facet_type, material AS concept_uri, 1 AS depth FROM samples WHERE material IS NOT NULL
  UNION ALL SELECT pid, 'material', 'm:root', 0 FROM samples WHERE material IS NOT NULL
  UNION ALL SELECT pid, 'context', context, 2 FROM samples UNION ALL SELECT pid, 'context', concat('c:r:', r_name), 1 FROM samples UNION ALL SELECT pid, 'context', 'c:root', 0 FROM samples
  UNION ALL SELECT pid, 'object_type', object_type, 1 FROM samples UNION ALL SELECT pid, 'object_type', 't:root', 0 FROM samples),
parent AS (SELECT DISTINCT concat('m:', o_orderpriority) AS uri, 'm:root' AS up FROM orders UNION ALL SELECT concat('c:r:', r_name), 'c:root' FROM region
  UNION ALL SELECT concat('c:n:', n_name), concat('c:r:', r_name) FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT concat('t:', s), 't:root' FROM (SELECT unnest(['F', 'O', 'P']) AS s)),
bits AS (SELECT facet_type, concept_uri, CAST(row_number() OVER (PARTITION BY facet_type ORDER BY concept_uri) - 1 AS INTEGER) AS bit_index FROM (SELECT DISTINCT facet_type, concept_uri FROM mem)),
masks AS (SELECT pid, """ + ", ".join(f"CAST(coalesce(bit_or(CASE WHEN facet_type = '{d}' THEN CAST(1 AS BIGINT) << bit_index END), 0) AS BIGINT) AS {d}_mask" for d in DIMS) + " FROM mem JOIN bits USING (facet_type, concept_uri) GROUP BY pid)"
W = f"WITH {BASE}"
SUMS = " UNION ALL ".join(f"SELECT '{d}' AS facet_type, {d} AS facet_value, count(*) AS count FROM {{0}} WHERE trim({d}) <> '' GROUP BY {d}" for d in FLAT)


# the build:


@query(f"{W} SELECT pid, source, material, context, object_type, label, description, concat('[\"', place, '\"]') AS place_name FROM samples")
def build_facets(spark, sf):
    return _table(spark, sf, "sample_facets_v2")


@query(f"{W} SELECT pid, label, source, latitude, longitude, place, result_time FROM samples")
def build_map_lite(spark, sf):
    return _table(spark, sf, "samples_map_lite").select("pid", "label", "source", "latitude", "longitude", F.array_join("place_name", ",").alias("place"), "result_time")


@query(f"{W} SELECT * FROM ({SUMS.format('samples')})")
def build_summaries(spark, sf):
    return _table(spark, sf, "facet_summaries").select("facet_type", "facet_value", "count")


@query(f"{W} {base._cube_sql(FLAT)}")
def build_cross_filter(spark, sf):
    return _table(spark, sf, "facet_cross_filter")


@query(f"{W} SELECT * FROM mem")
def build_membership(spark, sf):
    return _table(spark, sf, "sample_facet_membership")


@query(f"{W} SELECT facet_type, concept_uri, up AS parent_uri, min(depth) AS depth, count(*) AS count FROM mem LEFT JOIN parent ON uri = concept_uri GROUP BY 1, 2, 3")
def build_tree_summaries(spark, sf):
    return _table(spark, sf, "facet_tree_summaries")


@query(f"{W} SELECT facet_type, concept_uri, bit_index FROM bits")
def build_node_bits(spark, sf):
    return _table(spark, sf, "facet_node_bits").drop("build_id")


@query(f"{W} SELECT * FROM masks")
def build_masks(spark, sf):
    return _table(spark, sf, "sample_facet_masks").drop("build_id")


@query(f"{W} SELECT pid, source, {', '.join(f'coalesce({d}_mask, 0) AS {d}_mask' for d in DIMS)}, 1 AS schema_version FROM samples LEFT JOIN masks USING (pid)")
def build_index(spark, sf):
    return _table(spark, sf, "sample_facet_index").drop("build_id")


@query(f"{W} SELECT source, count(*) AS count, 1 AS schema_version, (SELECT count(*) FROM samples) AS total_rows FROM samples GROUP BY source")
def build_index_meta(spark, sf):
    return _table(spark, sf, "sample_facet_index_meta").drop("build_id")


@query(f"{W} SELECT pid, longitude AS x, latitude AS y FROM samples")
def decoded_points(spark, sf):
    """WKB geometry of samples as coordinates."""
    rows = graph.of_type(_graph(spark, sf), "MaterialSampleRecord").select("pid", geo.point(F.col("geometry")).alias("pt"))
    return rows.filter("pt.x is not null").select("pid", "pt.x", "pt.y")


@query(f"{W} SELECT concept_uri AS uri, facet_type FROM mem GROUP BY 1, 2")
def build_selected(spark, sf):
    """Only the node bits are asked for; what they need is built with them, and read back from the files."""
    path = fresh(spark, "selected")
    _build(spark, sf).write(path, only=["facet_node_bits"])
    forget_at_exit(spark, path)
    return tables.parquet(spark, f"{path}/facet_node_bits.parquet").join(tables.parquet(spark, f"{path}/sample_facet_membership.parquet").select("facet_type", "concept_uri").distinct(), ["facet_type", "concept_uri"], "left_semi").select(F.col("concept_uri").alias("uri"), "facet_type")


@query(f"{W} SELECT pid, k FROM samples WHERE material IS NOT NULL AND context IN ('c:n:NATION_7', 'c:n:NATION_12', 'c:n:NATION_3')")
def flat_slow_path(spark, sf):
    """The slow flat path: chosen values are predicates on the facet columns."""
    f = _table(spark, sf, "sample_facets_v2")
    got = fl.apply(f, fl.FilterState(values={"context": frozenset({"c:n:NATION_7", "c:n:NATION_12", "c:n:NATION_3"})}), ())
    return got.filter("material is not null").select("pid", F.substring("pid", 2, 20).cast("long").alias("k"))


@query(f"{W} SELECT pid, label, source, 'm:root' AS material_uri, 'Any material' AS material_label, context AS context_uri, n_name AS context_label FROM every WHERE pid = (SELECT min(pid) FROM every WHERE k % 4 = 0)")
def detail_card(spark, sf):
    """One sample with the labels of its first concepts."""
    g = _graph(spark, sf)
    c = _concepts(spark, sf)
    first = graph.of_type(g, "MaterialSampleRecord").filter("row_id % 4 = 0").agg(F.min("pid")).first()[0]
    s = graph.of_type(g, "MaterialSampleRecord").select("pid", "label", F.col("n").alias("source"), F.col("p__has_material_category").alias("material"), F.col("p__has_context_category").alias("context"))
    labels = c.select(F.col("pid").alias("uri"), F.upper("label").alias("pref_label"), F.lit("en").alias("lang")).withColumn("pref_label", F.when(F.col("uri") == "m:root", "Any material").otherwise(F.col("pref_label")))
    return views.detail(s, "pid", first, c, ["material", "context"], labels).select("pid", "label", "source", "material_uri", "material_label", "context_uri", "context_label")


@query(f"WITH {SAMPLES} SELECT count(*) AS sample_count, round(avg(latitude), 6) AS center_lat, round(avg(longitude), 6) AS center_lng, (SELECT source FROM samples WHERE o_custkey = 1 GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS dominant_source, count(DISTINCT source) AS source_count FROM samples WHERE o_custkey = 1")
def cell_card(spark, sf):
    return clusters.cell_card(base.samples(spark, sf), "o_custkey", 1)


@query(f"WITH {SAMPLES}, d AS (SELECT context AS cell, count(*) AS n, avg(latitude) AS a, avg(longitude) AS b FROM samples GROUP BY 1 HAVING count(*) > 500), m AS (SELECT context AS cell, source, row_number() OVER (PARTITION BY context ORDER BY count(*) DESC, source) AS r FROM samples GROUP BY 1, 2) SELECT d.cell AS context, n, m.source FROM d JOIN m ON m.cell = d.cell AND r = 1")
def dense_cells(spark, sf):
    return clusters.dense_cells(base.samples(spark, sf), "context", 500).select("context", "n", "source")


@query(f"WITH {SAMPLES}, s AS (SELECT context, source, count(*) AS c FROM samples GROUP BY 1, 2), d AS (SELECT context, source, row_number() OVER (PARTITION BY context ORDER BY c DESC, source) AS r, CAST(sum(c) OVER (PARTITION BY context) AS INTEGER) AS sample_count FROM s) SELECT context AS h3_cell, sample_count, source AS dominant_source FROM d WHERE r = 1 AND source IN ('BUILDING', 'MACHINERY')")
def clusters_of_sources(spark, sf):
    s = clusters.cluster_summary(base.samples(spark, sf), "context")
    return clusters.clusters_of_sources(s, ["BUILDING", "MACHINERY"]).select("h3_cell", "sample_count", "dominant_source")


@query(f"WITH {SAMPLES} SELECT pid FROM samples WHERE context IN ('NATION_7', 'NATION_12')")
def in_cells(spark, sf):
    cells = _t(spark, sf, "nation").filter("n_name in ('NATION_7', 'NATION_12')").select(F.col("n_name").alias("context"))
    return fl.in_cells(base.samples(spark, sf), cells.union(cells), "context").select("pid")


@query(f"{W} SELECT pid, n FROM (SELECT pid, count(*) AS n FROM mem WHERE facet_type = 'context' AND concept_uri IN ('c:n:NATION_7', 'c:r:ASIA') GROUP BY 1)")
def contains_any(spark, sf):
    """Samples whose list of nodes holds one of two values, and how many of them."""
    lists = _table(spark, sf, "sample_facet_membership").filter("facet_type = 'context'").groupBy("pid").agg(F.collect_list("concept_uri").alias("nodes"))
    two = ["c:n:NATION_7", "c:r:ASIA"]
    return lists.filter(ar.contains_any(F.col("nodes"), two)).select("pid", F.size(F.array_intersect("nodes", F.array(*[F.lit(x) for x in two]))).cast("long").alias("n"))


@query("SELECT o_orderkey, o_orderstatus = 'F' AS has_thumbnail FROM orders ORDER BY 2 DESC, 1 LIMIT 50")
def boolean_order(spark, sf):
    o = _t(spark, sf, "orders").withColumn("thumbnail_url", F.when(F.col("o_orderstatus") == "F", "x"))
    return views.with_thumbnail_first(o, "o_orderkey").select("o_orderkey", "has_thumbnail").limit(50)


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS BIGINT) AS k FROM orders ORDER BY k DESC NULLS LAST, o_orderkey LIMIT 300")
def mixed_order(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).cast("long").alias("k"))
    return views.ordered(o, "-k", "o_orderkey").limit(300)


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n, (SELECT count(*) FROM orders WHERE o_orderkey < 0) AS none")
def real_counts(spark, sf):
    """The real number where a cap was reached; the number shown where it was not."""
    o = _t(spark, sf, "orders")
    a, b = o.filter("o_orderstatus = 'F'"), o.filter("o_orderkey < 0")
    return local(spark, [(views.count_if_capped(a, 100, 100), views.count_if_capped(b, 0, 100))], n=pa.int64(), none=pa.int64())


@query("SELECT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS some, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'X') AS none")
def existence(spark, sf):
    o = _t(spark, sf, "orders")
    return local(spark, [(fl.exists(o, F.col("o_orderstatus") == "P"), fl.exists(o, F.col("o_orderstatus") == "X"))], some=pa.bool_(), none=pa.bool_())


@query("SELECT column_name AS name FROM (DESCRIBE orders)")
def described_columns(spark, sf):
    return local(spark, tables.describe(_t(spark, sf, "orders")), name=pa.string(), type=pa.string()).select("name")


@query("SELECT 'o_orderkey' AS found, true AS there, false AS missing")
def column_probe(spark, sf):
    o = _t(spark, sf, "orders")
    return local(spark, [(tables.first_existing(o, "pid", "o_orderkey"), tables.has_column(o, "o_custkey"), tables.has_column(o, "pid"))], found=pa.string(), there=pa.bool_(), missing=pa.bool_())


@query("SELECT concat('sample:', CAST(i AS VARCHAR)) AS pid, ['A', 'B', 'C', 'D'][i % 4 + 1] AS source, CASE i % 3 WHEN 0 THEN 'rock' WHEN 1 THEN 'mineral' ELSE 'organic' END AS material FROM range(1, 10001) t(i)")
def synthetic_rows(spark, sf):
    return tables.synthetic(spark, 10_000).select("pid", "source", "material")


@query("SELECT r_name AS name, 'region' AS kind FROM region UNION ALL SELECT r_name, 'region' FROM region")
def several_files(spark, sf):
    """A list of files, and a glob, read as one table each."""
    both = tables.parquet(spark, f"{sf}/region.parquet", f"{sf}/region.parquet").count() // 2
    globbed = tables.parquet(spark, f"{sf}/regio[n].parquet")
    return globbed.union(globbed.limit(both)).select(F.col("r_name").alias("name"), F.lit("region").alias("kind"))


@query("SELECT s_suppkey, s_suppkey % 3 AS k FROM supplier WHERE list_contains([0, 2], s_suppkey % 3)")
def literal_membership(spark, sf):
    s = _t(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 3).alias("k"))
    return s.filter(F.col("k").isin([0, 2]))


@query(f"{W} SELECT pid, place FROM every WHERE k % 3 = 0")
def place_lists(spark, sf):
    """Lists of places as text."""
    g = graph.of_type(_graph(spark, sf), "MaterialSampleRecord").filter(F.size("place_name") > 0)
    return g.select("pid", tx.place_text(F.col("place_name")).alias("place"))


@query("SELECT DISTINCT o_orderkey % 7 AS k, CAST(CASE WHEN o_orderkey % 7 >= 3 THEN 1 END AS INTEGER) AS n FROM orders")
def empty_lists_are_null(spark, sf):
    """A list all of whose ids are unknown is null after remapping, never empty."""
    keys = _t(spark, sf, "orders").select((F.col("o_orderkey") % 7).alias("k")).distinct().withColumn("a", F.array("k"))
    m = keys.filter("k >= 3").select(F.col("k").alias("old_id"), (F.col("k") + 100).alias("new_id"))
    return keys.select("k").join(ar.remap(keys, "k", "a", m), "k", "left").select("k", F.when(F.col("a").isNotNull(), F.size("a")).alias("n"))


# searches:


@query(f"WITH {base._WORDS} SELECT pid, field FROM post GROUP BY 1, 2")
def search_documents(spark, sf):
    """The documents of the index: fragments of all fields, those of concepts by their labels."""
    samples = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("pid"), F.col("source").alias("label"), F.col("text").alias("description"))
    none = local(spark, [], pid=pa.string(), concept=pa.int64())
    vocabulary = local(spark, [], uri=pa.string(), pref_label=pa.string(), lang=pa.string())
    return search.documents(search.fragments(samples, none, _concepts(spark, sf), vocabulary)).select("pid", "field")


@query("SELECT concat('n', CAST(n_nationkey AS VARCHAR)) AS pid, 'concept.label' AS field, CASE WHEN n_nationkey % 3 = 0 THEN n_name WHEN n_nationkey % 3 = 1 THEN concat('own ', n_name) ELSE CAST(n_nationkey AS VARCHAR) END AS text FROM nation")
def concept_fragments(spark, sf):
    """A concept is named by its vocabulary, else by itself, else by the tail of its URI."""
    n = _t(spark, sf, "nation")
    uri = F.concat(F.lit("http://v/"), F.col("n_nationkey").cast("string"))
    concepts = n.select(F.col("n_nationkey").alias("row_id"), uri.alias("pid"), F.when(F.col("n_nationkey") % 3 != 2, F.concat(F.lit("own "), "n_name")).alias("label"))
    vocabulary = n.filter("n_nationkey % 3 = 0").select(uri.alias("uri"), F.col("n_name").alias("pref_label"), F.lit("en").alias("lang"))
    links = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("pid"), F.col("n_nationkey").alias("concept"))
    blank = links.select("pid", F.lit(None).cast("string").alias("label"), F.lit(" ").alias("description"))
    return search.fragments(blank, links, concepts, vocabulary)


@query(f"WITH {base._WORDS}, best AS (SELECT pid, sum(c) AS s FROM contrib WHERE token = 'src3' GROUP BY pid), area AS (SELECT CAST(doc_id AS VARCHAR) AS pid, lang FROM documents WHERE lang = 'en') SELECT pid, lang, round(s, 6) AS score FROM area JOIN best USING (pid) ORDER BY s DESC, pid LIMIT 20")
def search_area(spark, sf):
    scored = search.answer("src3", base._stored(spark, sf), base._stats(spark, sf), search.Manifest(base.INDEX_SHARDS), top=None)
    d = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("pid"), "lang")
    return views.search_area(scored, d, F.col("lang") == "en", 20).withColumn("score", F.round("score", 6))


@query(f"WITH {base._WORDS}, best AS (SELECT pid, sum(c) AS s FROM contrib WHERE token = 'src3' GROUP BY pid ORDER BY s DESC, pid LIMIT 20) SELECT pid, lang, round(s, 6) AS score FROM best LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS pid, lang FROM documents WHERE lang = 'en') USING (pid)")
def search_world(spark, sf):
    scored = search.answer("src3", base._stored(spark, sf), base._stats(spark, sf), search.Manifest(base.INDEX_SHARDS), top=None)
    d = _t(spark, sf, "documents").filter("lang = 'en'").select(F.col("doc_id").cast("string").alias("pid"), "lang")
    return views.search_world(scored, d, 20).withColumn("score", F.round("score", 6))


@query(f"WITH {base._WORDS}, hot AS (SELECT token FROM post GROUP BY token HAVING count(*) > 200), per AS (SELECT token, pid, round(sum(c), 4) AS s FROM contrib JOIN hot USING (token) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY s DESC, pid) AS k FROM per QUALIFY k <= 500) SELECT pid, round(sum(s), 4) AS score FROM r WHERE token IN ('that', 'and') GROUP BY pid HAVING count(*) = 2 ORDER BY 2 DESC, 1 LIMIT 50")
def topk_intersection(spark, sf):
    """The mode for common words only: their ready lists are intersected."""
    return search.rank_topk(base._hot_lists(spark, sf), ["that", "and"]).withColumn("score", F.round("score", 4))


@query("SELECT * FROM (VALUES ('', 'empty', '', ''), ('the of', 'allStopwords', '', ''), ('The RED and red pottery', 'normal', 'red pottery', ''), ('that src3', 'normal', 'src3', 'that'), ('that', 'topk', 'that', '')) t(query, mode, tokens, ignored)")
def query_plans(spark, sf):
    m = search.Manifest(base.INDEX_SHARDS, hot={"that": ("that", 3, 10**9, False)})
    rows = []
    for q in ("", "the of", "The RED and red pottery", "that src3", "that"):
        p = search.plan(q, m)
        rows.append((q, p.mode, " ".join(p.tokens), " ".join(p.ignored)))
    return local(spark, rows, query=pa.string(), mode=pa.string(), tokens=pa.string(), ignored=pa.string())


@query("SELECT * FROM (VALUES ('pottery', true), ('ark:/1/2', false), ('x', false), ('igsn:abc', false), ('a b', true)) t(query, indexed)")
def search_routes(spark, sf):
    return local(spark, [(q, search.use_index(q.split())) for q in ("pottery", "ark:/1/2", "x", "igsn:abc", "a b")], query=pa.string(), indexed=pa.bool_())


@query(f"WITH {base._WORDS} SELECT token, pid, field, tf, doc_len, df FROM post JOIN dfs USING (token)")
def index_on_disk(spark, sf):
    """All postings, read back from an index whose files keep to a cap of bytes."""
    return search.open_index(spark, written_index(spark, sf))[0].select("token", "pid", "field", "tf", "doc_len", "df")


def written_index(spark, sf):
    """The path of the index, written once for an application."""

    def make():
        path = fresh(spark, "index")
        search.write_index(base._stored(spark, sf), path, cap_bytes=1 << 17, shards=base.INDEX_SHARDS)
        forget_at_exit(spark, path)
        return path

    return made_once(spark, ("index-on-disk", sf), make)


@query(f"WITH {base._WORDS} SELECT pid, round(sum(c), 6) AS score FROM contrib WHERE token IN ('src3', 'thing') GROUP BY pid HAVING count(DISTINCT token) = 2 ORDER BY 2 DESC, 1 LIMIT 50")
def search_on_disk(spark, sf):
    """A search that reads its shards and hot files of the written index only."""
    rows, m = search.open_index(spark, written_index(spark, sf))
    m = dataclasses.replace(m, hot={t: (k, p, b, True) for t, (k, p, b, _) in m.hot.items()})
    return search.answer("thing src3", rows, base._stats(spark, sf), m).withColumn("score", F.round("score", 6))


# checks, on tables with planted faults:

LOCATED = "(SELECT count(*) FROM samples WHERE {0})"


def _check_sql(*rows: tuple[str, str]) -> str:
    """(check, passed, detail) of checks by the SQL of their number of bad rows."""
    return f"{W}, n AS (" + " UNION ALL ".join(f"SELECT '{name}' AS name, ({sql}) AS k" for name, sql in rows) + ') SELECT name AS "check", k = 0 AS passed, concat(CAST(k AS VARCHAR), \' rows\') AS detail FROM n'


def _only(rows, *names):
    return rows.filter(F.col("check").isin(list(names)))


def _broken_facets(spark, sf):
    f = _table(spark, sf, "sample_facets_v2")
    k = F.substring("pid", 2, 20).cast("long")
    f = f.withColumn("material", F.when(k % 89 == 0, "m:root").otherwise(F.col("material")))
    return f.union(f.filter(k % 97 == 0))


def _flat_tables(spark, sf, *names):
    """The tables of a check: facets and map with faults, and those named."""
    k = F.substring("pid", 2, 20).cast("long")
    lite = _table(spark, sf, "samples_map_lite").filter(k % 83 != 0)
    return {"sample_facets_v2": _broken_facets(spark, sf), "samples_map_lite": lite, **{n: _table(spark, sf, n) for n in names}}


@query(_check_sql(("no root as a facet value", "SELECT count(*) + count(*) FILTER (k % 97 = 0) FROM samples WHERE k % 89 = 0"), ("facet pids", "SELECT count(*) FROM samples WHERE k % 97 = 0"), ("map pids", "SELECT 0"), ("facets and map have the same pids", "SELECT count(*) FROM samples WHERE k % 83 = 0")))
def val_pids(spark, sf):
    return _only(checks.flat_pids(_flat_tables(spark, sf), ROOTS), "no root as a facet value", "facet pids", "map pids", "facets and map have the same pids")


_BAD = "bad AS (SELECT pid, source, CASE WHEN k % 89 = 0 THEN 'm:root' ELSE material END AS material, context, object_type FROM samples UNION ALL SELECT pid, source, CASE WHEN k % 89 = 0 THEN 'm:root' ELSE material END, context, object_type FROM samples WHERE k % 97 = 0)"
_DIFF = "SELECT (SELECT count(*) FROM ({0} EXCEPT {1})) + (SELECT count(*) FROM ({1} EXCEPT {0}))"


def _two(a, b):
    return _DIFF.format(f"(SELECT * FROM ({a}))", f"(SELECT * FROM ({b}))")


@query(_check_sql(("summaries", _two(SUMS.format("samples"), SUMS.format("bad"))), ("summaries have no scheme and no blanks", "SELECT 0")).replace(f"{W},", f"{W}, {_BAD},"))
def val_summaries(spark, sf):
    return _only(checks.flat_summaries(_flat_tables(spark, sf, "facet_summaries")), "summaries", "summaries have no scheme and no blanks")


@query(_check_sql(("cube grain", "SELECT 0"), ("cube", _two(base._cube_sql(FLAT), base._cube_sql(FLAT).replace("FROM samples", "FROM bad"))), ("cube baseline", "SELECT 0")).replace(f"{W},", f"{W}, {_BAD},"))
def val_cube(spark, sf):
    return _only(checks.flat_cube(_flat_tables(spark, sf, "facet_summaries", "facet_cross_filter")), "cube grain", "cube", "cube baseline")


@query(_check_sql(("h3_summary_res4 counts all", "SELECT CAST(EXISTS (SELECT 1 FROM samples WHERE k % 83 = 0) AS BIGINT)")))
def val_cells(spark, sf):
    return checks.flat_cells(_flat_tables(spark, sf, "h3_summary_res4"))[0]


@query(_check_sql(("sample_facets_v2 rebuilt", "SELECT 2 * count(*) FROM samples WHERE k % 89 = 0 AND (material IS NULL OR material <> 'm:root')"), ("facet_summaries rebuilt", "SELECT 0")))
def val_rebuilt(spark, sf):
    """Tables against their definition; of facets one column was changed."""
    return checks.rebuilt({"sample_facets_v2": _broken_facets(spark, sf), "facet_summaries": _table(spark, sf, "facet_summaries")}, _build(spark, sf, alone=True))


def _tree_tables(spark, sf, *names):
    t = _table(spark, sf, "facet_tree_summaries")
    t = t.filter("concept_uri <> 'c:r:ASIA'").withColumn("count", F.when(F.col("concept_uri") == "t:F", F.col("count") + 10**9).otherwise(F.col("count")))
    m = _table(spark, sf, "sample_facet_membership")
    return {"facet_tree_summaries": t, "sample_facet_membership": m.union(m.filter("concept_uri = 'c:n:NATION_7'")), **{n: _table(spark, sf, n) for n in names}}


@query(_check_sql(("parents count at least their children", "SELECT 1"), ("parents exist", "SELECT count(DISTINCT concept_uri) FROM mem JOIN parent ON uri = concept_uri WHERE up = 'c:r:ASIA'"), ("one root in each dimension", "SELECT 0")))
def val_tree(spark, sf):
    return _only(checks.tree_shape(_tree_tables(spark, sf), ROOTS), "parents count at least their children", "parents exist", "one root in each dimension")


@query(_check_sql(("membership grain", "SELECT count(*) FROM mem WHERE concept_uri = 'c:n:NATION_7'"), ("tree counts", "SELECT 1 + 2")))
def val_membership(spark, sf):
    return _only(checks.tree_members(_tree_tables(spark, sf)), "membership grain", "tree counts")


@query(_check_sql(("tree cube grain", "SELECT 0"), ("tree cube has no filter on its own dimension", "SELECT 0"), ("tree cube baseline", "SELECT 1 + 2")))
def val_tree_cube(spark, sf):
    return _only(checks.tree_cube(_tree_tables(spark, sf, "facet_tree_cross_filter", "sample_facets_v2")), "tree cube grain", "tree cube has no filter on its own dimension", "tree cube baseline")


def _mask_tables(spark, sf):
    k = _table(spark, sf, "sample_facet_masks")
    n = F.substring("pid", 2, 20).cast("long")
    changed = k.withColumn("object_type_mask", F.when(n % 61 == 0, F.lit(0).cast("long")).otherwise(F.col("object_type_mask")))
    b = _table(spark, sf, "facet_node_bits").filter("concept_uri <> 'c:n:NATION_7'")
    return {"sample_facet_masks": changed.union(changed.filter(n % 67 == 0)), "facet_node_bits": b, "sample_facet_membership": _table(spark, sf, "sample_facet_membership")}


@query(_check_sql(("bits are dense and at most 62", "SELECT 1"), ("bits cover the nodes", "SELECT 1"), ("mask pids", "SELECT count(*) FROM samples WHERE k % 67 = 0"), ("bits and masks are of one build", "SELECT 0"), ("object_type: mask filter and membership filter", "SELECT count(*) FROM samples WHERE k % 61 = 0")))
def val_masks(spark, sf):
    return _only(checks.masks(_mask_tables(spark, sf)), "bits are dense and at most 62", "bits cover the nodes", "mask pids", "bits and masks are of one build", "object_type: mask filter and membership filter")


def _index_tables(spark, sf, *names):
    i = _table(spark, sf, "sample_facet_index")
    n = F.substring("pid", 2, 20).cast("long")
    i = i.filter(n % 71 != 0).withColumn("source", F.when(n % 73 == 0, "WRONG").otherwise(F.col("source"))).withColumn("schema_version", F.when(n % 79 == 0, 2).otherwise(F.col("schema_version")))
    return {"sample_facet_index": i, **{x: _table(spark, sf, x) for x in names}}


@query(_check_sql(("index has no nulls", "SELECT 0"), ("index pids", "SELECT 0"), ("index is complete", "SELECT count(*) FROM samples WHERE k % 71 = 0"), ("index sources", "SELECT count(*) FROM samples WHERE k % 71 = 0 OR k % 73 = 0"), ("index version", "SELECT count(*) FROM samples WHERE k % 79 = 0 AND k % 71 <> 0"), ("index build id has two halves", "SELECT 0"), ("index build id", "SELECT 0"), ("index masks", "SELECT 0")))
def val_index(spark, sf):
    return _only(checks.index_rows(_index_tables(spark, sf, "samples_map_lite", "sample_facet_masks", "sample_facets_v2", "sample_facet_membership")), "index has no nulls", "index pids", "index is complete", "index sources", "index version", "index build id has two halves", "index build id", "index masks")


@query(_check_sql(("index meta", _two("SELECT source, count(*) AS n FROM samples GROUP BY 1", "SELECT CASE WHEN k % 73 = 0 THEN 'WRONG' ELSE source END, count(*) FROM samples WHERE k % 71 <> 0 GROUP BY 1")), ("index meta total", "SELECT CAST(EXISTS (SELECT 1 FROM samples WHERE k % 71 = 0) AS BIGINT)"), ("index meta and summaries", "SELECT 0")))
def val_index_meta(spark, sf):
    return _only(checks.index_meta(_index_tables(spark, sf, "sample_facet_index_meta", "facet_summaries")), "index meta", "index meta total", "index meta and summaries")


@query(_check_sql(("cells at resolution 4", "SELECT CAST(count(DISTINCT n_nationkey) AS BIGINT) FROM samples WHERE n_nationkey = 7")))
def val_lite(spark, sf):
    """Cells of a map table against its summary, in which one cell is wrong."""
    lite = _table(spark, sf, "samples_map_lite")
    hit = lite.filter("latitude = -9 and longitude = -31").agg(F.min("h3_res4")).first()[0]
    s = _table(spark, sf, "h3_summary_res4").withColumn("sample_count", F.when(F.col("h3_cell") == hit, F.col("sample_count") + 1).otherwise(F.col("sample_count")))
    return checks.lite_against(lite, {4: s})


@query("SELECT CAST(count(*) AS BIGINT) AS files, true AS same, true AS told FROM (SELECT unnest(['a', 'b']))")
def val_manifest(spark, sf):
    """Digests of written files are those of a manifest, until a file changes."""
    import os
    import tempfile

    with tempfile.TemporaryDirectory() as d:  # two files of the driver, as a publisher has them
        for n in ("a", "b"):
            with open(os.path.join(d, n), "w") as f:
                f.write(n)
        first = {n: sinks.sha256(os.path.join(d, n)) for n in ("a", "b")}
        again = {n: sinks.sha256(os.path.join(d, n)) for n in ("a", "b")}
        with open(os.path.join(d, "b"), "w") as f:
            f.write("c")
        changed = sinks.sha256(os.path.join(d, "b"))
    return local(spark, [(len(first), first == again, changed != first["b"])], files=pa.int64(), same=pa.bool_(), told=pa.bool_())


# overlays and synchronisation:

OURS_COLUMNS = "row_id long, pid string, otype string, n string, label string, p__produced_by array<bigint>, p__has_material_category array<bigint>"


def _side(spark, sf, samples, base_id, source, concepts, label):
    """A graph of suppliers: an event for each nation, concepts by number."""
    s = _t(spark, sf, "supplier").filter(samples)
    ids = F.array(*[(F.lit(base_id + 9000) + F.expr(c)).cast("long") for c in concepts])
    none = F.lit(None).cast("array<bigint>")
    rows = s.select((F.lit(base_id) + F.col("s_suppkey")).cast("long").alias("row_id"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("pid"), F.lit("MaterialSampleRecord").alias("otype"), source.alias("n"), F.lit(label).alias("label"), F.array((F.lit(base_id + 5000) + F.col("s_nationkey")).cast("long")).alias("p__produced_by"), ids.alias("p__has_material_category"))
    ev = s.select("s_nationkey").distinct().select((F.lit(base_id + 5000) + F.col("s_nationkey")).cast("long"), F.concat(F.lit("e"), F.col("s_nationkey").cast("string")), F.lit("SamplingEvent"), F.lit(None).cast("string"), F.lit(label), none, none)
    each = None
    for c in concepts:
        one = s.select(F.expr(c).cast("long").alias("c"))
        each = one if each is None else each.union(one)
    co = each.distinct().select((F.lit(base_id + 9000) + F.col("c")).cast("long"), F.concat(F.lit("c"), F.col("c").cast("string")), F.lit("IdentifiedConcept"), F.lit(None).cast("string"), F.lit(label), none, none)
    return rows.union(ev).union(co)


def _ours(spark, sf):
    return _side(spark, sf, "s_suppkey <= 60", 0, F.when(F.col("s_suppkey") % 2 == 0, "SRC").otherwise("OTHER"), ["s_nationkey % 4"], "ours")


def _theirs(spark, sf):
    return _side(spark, sf, "s_suppkey between 21 and 100 and s_suppkey % 2 = 0", 100_000, F.lit("SRC"), ["s_nationkey % 5", "s_suppkey % 3 + 10"], "theirs")


SIDES = """ours AS (SELECT s_suppkey AS k, s_nationkey AS e, s_suppkey % 2 = 0 AS src FROM supplier WHERE s_suppkey <= 60), theirs AS (SELECT s_suppkey AS k, s_nationkey AS e FROM supplier WHERE s_suppkey BETWEEN 21 AND 100 AND s_suppkey % 2 = 0),
removed AS (SELECT k, e FROM ours WHERE src AND k NOT IN (SELECT k FROM theirs)), added AS (SELECT k, e FROM theirs WHERE k NOT IN (SELECT k FROM ours WHERE src)),
stay AS (SELECT k, e FROM ours WHERE k NOT IN (SELECT k FROM removed)), gone AS (SELECT DISTINCT e FROM removed WHERE e NOT IN (SELECT e FROM stay)),
events AS (SELECT DISTINCT e, 'ours' AS label FROM stay UNION SELECT DISTINCT e, 'theirs' FROM added WHERE e NOT IN (SELECT e FROM stay))"""


def _named(df):
    """(pid, otype, label, refs): a graph whose references are spelt out, in order."""
    names = df.select(F.col("row_id").alias("o"), F.col("pid").alias("name"))
    flat = df.select("row_id", F.posexplode(F.concat(F.coalesce("p__produced_by", F.array().cast("array<bigint>")), F.coalesce("p__has_material_category", F.array().cast("array<bigint>")))).alias("pos", "o")).join(names, "o")
    refs = flat.groupBy("row_id").agg(F.array_join(ar.ordered_list(F.col("name"), F.col("pos")), " ").alias("refs"))
    return df.join(refs, "row_id", "left").select("pid", "otype", "label", F.coalesce("refs", F.lit("")).alias("refs"))


@query(f"""WITH {SIDES}, co AS (SELECT DISTINCT e % 4 AS c FROM ours), added_co AS (SELECT DISTINCT e % 5 AS c FROM added UNION SELECT DISTINCT k % 3 + 10 FROM added)
SELECT concat('s', CAST(k AS VARCHAR)) AS pid, 'MaterialSampleRecord' AS otype, 'ours' AS label, concat('e', CAST(e AS VARCHAR), ' c', CAST(e % 4 AS VARCHAR)) AS refs FROM stay
UNION ALL SELECT concat('s', CAST(k AS VARCHAR)), 'MaterialSampleRecord', 'theirs', concat('e', CAST(e AS VARCHAR), ' c', CAST(e % 5 AS VARCHAR), ' c', CAST(k % 3 + 10 AS VARCHAR)) FROM added
UNION ALL SELECT concat('e', CAST(e AS VARCHAR)), 'SamplingEvent', label, '' FROM events
UNION ALL SELECT concat('c', CAST(c AS VARCHAR)), 'IdentifiedConcept', 'ours', '' FROM co
UNION ALL SELECT concat('c', CAST(c AS VARCHAR)), 'IdentifiedConcept', 'theirs', '' FROM added_co WHERE c NOT IN (SELECT c FROM co)""")
def sync_result(spark, sf):
    """A source made equal to the other side's; references are compared by name, so the new ids must lead where they should."""
    return _named(sync.true_sync(_ours(spark, sf), _theirs(spark, sf), "SRC"))


@query(f"WITH {SIDES} SELECT concat('s', CAST(k AS VARCHAR)) AS pid, 'removed' AS side FROM removed UNION ALL SELECT concat('s', CAST(k AS VARCHAR)), 'added' FROM added")
def sync_difference(spark, sf):
    removed, added = sync.difference(_ours(spark, sf), _theirs(spark, sf), "SRC")
    return removed.select("pid", F.lit("removed").alias("side")).union(added.select("pid", F.lit("added")))


@query(f"WITH {SIDES} SELECT concat('s', CAST(k AS VARCHAR)) AS pid FROM added UNION ALL SELECT DISTINCT concat('e', CAST(e AS VARCHAR)) FROM added")
def sync_subgraph(spark, sf):
    theirs = _theirs(spark, sf)
    _, added = sync.difference(_ours(spark, sf), theirs, "SRC")
    return theirs.join(sync.subgraph(theirs, added), "row_id").select("pid")


@query(f"WITH {SIDES} SELECT concat('s', CAST(k AS VARCHAR)) AS pid, [CAST(7000 + e AS BIGINT)] AS events, [CAST(8000 + e % 5 AS BIGINT), CAST(8010 + k % 3 AS BIGINT)] AS concepts FROM theirs")
def sync_remap(spark, sf):
    """Reference columns under new ids, in order, with as many entries as before."""
    theirs = _theirs(spark, sf)
    number = F.substring("pid", 2, 20).cast("long")
    m = theirs.filter("otype <> 'MaterialSampleRecord'").select(F.col("row_id").alias("old_id"), (number + F.when(F.col("otype") == "SamplingEvent", 7000).otherwise(8000)).alias("new_id"))
    rows = graph.of_type(theirs, "MaterialSampleRecord")
    return sync.remap_columns(rows, m, ["p__produced_by", "p__has_material_category"]).select("pid", F.col("p__produced_by").alias("events"), F.col("p__has_material_category").alias("concepts"))


@query(f"WITH {SIDES} SELECT concat('s', CAST(k AS VARCHAR)) AS pid, CASE WHEN k BETWEEN 21 AND 60 AND src THEN concat('e', CAST(e AS VARCHAR), ' c', CAST(e % 5 AS VARCHAR), ' c', CAST(k % 3 + 10 AS VARCHAR)) ELSE concat('e', CAST(e AS VARCHAR), ' c', CAST(e % 4 AS VARCHAR)) END AS refs FROM ours")
def concept_overlay(spark, sf):
    """Their concepts replace ours where both have the sample; unknown ones are minted."""
    out = sync.concept_overlay(_ours(spark, sf), _theirs(spark, sf), ["p__has_material_category"])
    return _named(out).filter("otype = 'MaterialSampleRecord'").select("pid", "refs")


@query(f"WITH {SIDES} SELECT 'p__has_material_category: lists equal theirs' AS \"check\", false AS passed, concat(CAST(count(*) AS VARCHAR), ' rows') AS detail FROM ours WHERE k BETWEEN 21 AND 60 AND src UNION ALL SELECT 'overlay ids', true, '0 rows' UNION ALL SELECT 'overlay leaves other columns', true, '0 rows' UNION ALL SELECT 'p__has_material_category: other samples unchanged', true, '0 rows'")
def val_overlay(spark, sf):
    """The check of an overlay that did nothing: every list that should be theirs is told."""
    ours = _ours(spark, sf)
    got = checks.overlay(ours, ours, _theirs(spark, sf), ["p__has_material_category"])
    return _only(got, "p__has_material_category: lists equal theirs", "overlay ids", "overlay leaves other columns", "p__has_material_category: other samples unchanged")


@query(f"WITH {SIDES} SELECT concat('s', CAST(k AS VARCHAR)) AS pid, 'produced_by' AS p FROM ours WHERE e = 3 UNION ALL SELECT concat('s', CAST(k AS VARCHAR)), 'has_material_category' FROM ours WHERE e % 4 = 1")
def sync_dangling(spark, sf):
    """References to rows that were taken out, in any column."""
    ours = _ours(spark, sf).filter("pid not in ('e3', 'c1')")
    return sync.dangling(ours).join(ours.select(F.col("row_id").alias("s"), "pid"), "s").select("pid", "p")


@query("SELECT s_suppkey, CASE WHEN s_nationkey = 4 AND s_suppkey % 3 = 0 THEN concat('new ', s_name) ELSE s_name END AS s_name FROM supplier")
def overlay_where(spark, sf):
    """Descriptions of one source from a lookup; all other rows stay."""
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    lookup = s.filter("s_suppkey % 3 = 0").select("s_suppkey", F.concat(F.lit("new "), "s_name").alias("s_name"))
    return sync.overlay_where(s, lookup, "s_suppkey", "s_name", F.col("s_nationkey") == 4).select("s_suppkey", "s_name")


@query("SELECT 'row_id is null or repeated' AS rule, true AS raised UNION ALL SELECT 'unresolved concept', true UNION ALL SELECT 'output over input', true UNION ALL SELECT 'pids of another source', true")
def sync_refusals(spark, sf):
    """Jobs that must not go on raise before anything is written."""
    ours, theirs = _ours(spark, sf), _theirs(spark, sf)

    def raises(job):
        try:
            job()
        except (sync.SyncError, ValueError):
            return True
        return False

    rows = [
        ("row_id is null or repeated", raises(lambda: sync.concept_overlay(ours.union(ours.filter("pid = 's1'")), theirs, ["p__has_material_category"]))),
        ("unresolved concept", raises(lambda: sync.concept_overlay(ours, theirs.filter("pid <> 'c10'"), ["p__has_material_category"]))),
        ("output over input", raises(lambda: sinks.replace(ours, "/x/y", source="/x/y/"))),
        ("pids of another source", raises(lambda: sync.difference(ours.withColumn("n", F.lit("OTHER")), theirs, "SRC"))),
    ]
    return local(spark, rows, rule=pa.string(), raised=pa.bool_())


@query("SELECT concat('g', CAST(n_nationkey AS VARCHAR)) AS pid, CAST(n_nationkey * 3 - 30 AS DOUBLE) AS latitude, CAST(n_nationkey * 7 - 80 AS DOUBLE) AS longitude, location_type FROM (" + base._USE + ") u JOIN nation ON row_id = n_nationkey + 3000000000")
def geocode_table(spark, sf):
    """Every place with its coordinates and what it is used for."""
    blobs = local(spark, [(base.G0 + i, geo.encode_point(i * 7.0 - 80, i * 3.0 - 30)) for i in range(25)], row_id=pa.int64(), geometry=pa.binary())
    w = base.wide(spark, sf).join(blobs, "row_id", "left").withColumn("pid", F.when(F.col("otype") == "GeospatialCoordLocation", F.concat(F.lit("g"), (F.col("row_id") - base.G0).cast("string"))).otherwise(F.col("pid")))
    return geocodes(w, graph.wide_edges(w))


# helpers of a screen:


@query("SELECT * FROM (VALUES ('world', true), ('wrapped', false), ('far', true), ('near', false), ('none', true)) t(view, is_global)")
def global_views(spark, sf):
    world, wrapped, small = geo.BBox(-89, -179, 89, 179), geo.BBox(-89, 170, 89, -170), geo.BBox(0, 0, 10, 10)
    rows = [("world", geo.is_global_view(1e6, world)), ("wrapped", geo.is_global_view(1e6, wrapped)), ("far", geo.is_global_view(2e7, small)), ("near", geo.is_global_view(1e5, small)), ("none", geo.is_global_view(None, None))]
    return local(spark, rows, view=pa.string(), is_global=pa.bool_())


@query("SELECT * FROM (VALUES (5000000, 4), (1000000, 6), (100000, 8)) t(altitude, resolution)")
def cell_resolutions(spark, sf):
    return local(spark, [(a, geo.resolution_for(a)) for a in (5_000_000, 1_000_000, 100_000)], altitude=pa.int32(), resolution=pa.int32())


@query(f"{W}, c AS (SELECT unnest(['c:r:ASIA', 'c:n:NATION_7', 'c:n:NATION_3']) AS uri) SELECT uri FROM c WHERE uri NOT IN (SELECT p.uri FROM parent p JOIN c ON p.up = c.uri)")
def smallest_selection(spark, sf):
    """Chosen nodes without those whose ancestor is chosen, too."""
    up = {r.uri: r.broader for r in _vocabulary(spark, sf).collect()}  # a vocabulary
    return local(spark, [(u,) for u in sorted(fl.minimal_selection({"c:r:ASIA", "c:n:NATION_7", "c:n:NATION_3"}, up))], uri=pa.string())


@query("SELECT * FROM (VALUES ('known', true), ('unknown', false), ('nothing chosen', true)) t(state, by_mask)")
def mask_path_refused(spark, sf):
    """A node without a bit refuses the whole path by masks, so that it cannot match nothing by mistake."""
    bits = {("place", "a"): 0}
    rows = [("known", {"place": frozenset({"a"})}), ("unknown", {"place": frozenset({"a", "b"})}), ("nothing chosen", {})]
    return local(spark, [(n, fl.node_masks(x, bits) is not None) for n, x in rows], state=pa.string(), by_mask=pa.bool_())


@query("SELECT * FROM (VALUES ('a', true, false), ('b', false, false), ('c', false, true)) t(name, missing, extra)")
def manifest_differences(spark, sf):
    d = sinks.pinned_against(["a", "b"], ["b", "c"])
    return local(spark, [(n, n in d["missing"], n in d["extra"]) for n in "abc"], name=pa.string(), missing=pa.bool_(), extra=pa.bool_())


@query("SELECT * FROM (VALUES ('https://x.org/data', 'https://x.org/data'), ('https://x.org/\"', 'https://d'), ('javascript:1', 'https://d')) t(given, used)".replace('\\"', '"'))
def base_urls(spark, sf):
    return local(spark, [(u, tables.base_url(u, "https://d")) for u in ("https://x.org/data", 'https://x.org/"', "javascript:1")], given=pa.string(), used=pa.string())


@query("SELECT r_name AS name, true AS same FROM region")
def written_at_a_level(spark, sf):
    """ZSTD at level nine keeps the rows."""
    path = fresh(spark, "level")
    r = _t(spark, sf, "region").select(F.col("r_name").alias("name"))
    sinks.write(r, path, "name", level=9)
    forget_at_exit(spark, path)
    return tables.parquet(spark, path).join(r.withColumn("same", F.lit(True)), "name")


@query("SELECT count(*) * 100 >= 2 * (SELECT count(*) FROM orders) AS enough, count(*) * 100 <= 40 * (SELECT count(*) FROM orders) AS not_too_many, true AS repeatable FROM orders WHERE o_orderkey % 10 = 0")
def samples_of_rows(spark, sf):
    """About one row in ten by hash and by chance; both the same each time."""
    o = _t(spark, sf, "orders")
    n, a, b, c = o.count(), fl.hash_sample(o, "o_orderkey", 10), fl.bernoulli_sample(o, 0.1, 7), fl.bernoulli_sample(o, 0.1, 7)
    counts = [a.count(), b.count()]
    same = setops.symmetric_difference(b.select("o_orderkey"), c.select("o_orderkey")).isEmpty()
    return local(spark, [(min(counts) * 100 >= 2 * n, max(counts) * 100 <= 40 * n, same)], enough=pa.bool_(), not_too_many=pa.bool_(), repeatable=pa.bool_())


@query(f"WITH {SAMPLES} SELECT source, count(*) AS by_scan, count(*) AS by_summary FROM samples GROUP BY source")
def counted_two_ways(spark, sf):
    """A histogram by a scan, and from the summaries."""
    s = base.samples(spark, sf)
    a = s.groupBy("source").agg(F.count(F.lit(1)).alias("by_scan"))
    b = facets.summaries(s, base.FLAT).filter("facet_type = 'source'").select(F.col("facet_value").alias("source"), F.col("count").alias("by_summary"))
    return a.join(b, "source")


@query(f"{W}, near AS (SELECT n_nationkey FROM samples WHERE latitude BETWEEN -20 AND 10 AND longitude BETWEEN -60 AND 0) SELECT (SELECT count(*) FROM near) AS in_box, (SELECT count(*) FROM samples WHERE n_nationkey IN (SELECT n_nationkey FROM near)) AS in_cells")
def box_and_cells(spark, sf):
    """The rows of a box, and those of the cells it touches (at points this far apart they are the same)."""
    lite = _table(spark, sf, "samples_map_lite")
    box = lite.filter(geo.BBox(-20, -60, 10, 0).where(F.col("latitude"), F.col("longitude")))
    return local(spark, [(box.count(), fl.in_cells(lite, box, "h3_res8").count())], in_box=pa.int64(), in_cells=pa.int64())


@query("SELECT s_suppkey, c FROM (SELECT s_suppkey, s_suppkey % 10 / 10.0 AS c FROM supplier) WHERE c >= 0.8")
def confident(spark, sf):
    s = _t(spark, sf, "supplier").select("s_suppkey", ((F.col("s_suppkey") % 10) / 10.0).alias("c"))
    return fl.confident(s, "c", 0.8)


def queries():
    return base.queries()


def oracle_sql():
    return base.oracle_sql()
