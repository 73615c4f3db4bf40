"""From the wide graph to the derived tables: base tables, artefacts, and their order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as ar
from ..functions import geo
from ..lineage import checkpointed, local, written
from ..operators import clusters, facets, graph, hierarchy, quality

DIMS = ("material", "context", "object_type")
REFERENCES = dict(zip(DIMS, ("p__has_material_category", "p__has_context_category", "p__has_sample_object_type")))
KEYWORDS = "p__keywords"
RESOLUTIONS = (4, 6, 8)
FLAT = ("source", *DIMS)

# An artefact and what it is built from.
NEEDS: dict[str, tuple[str, ...]] = {
    "sample_facets_v2": (),
    "samples_map_lite": (),
    **{f"h3_summary_res{r}": () for r in RESOLUTIONS},
    "facet_summaries": (),
    "facet_cross_filter": (),
    "wide_h3": (),
    "sample_facet_membership": (),
    "facet_tree_summaries": ("sample_facet_membership",),
    "facet_tree_cross_filter": ("sample_facet_membership",),
    "facet_node_bits": ("sample_facet_membership",),
    "sample_facet_masks": ("sample_facet_membership", "facet_node_bits"),
    "sample_facet_index": ("sample_facet_membership", "facet_node_bits"),
    "sample_facet_index_meta": (),
}


def selection(only: Sequence[str] | None = None, skip: Sequence[str] = ()) -> list[str]:
    """Artefacts to build, in order, with what they need; unknown names raise.

    What is skipped by name is still built where another chosen artefact needs it.
    """
    unknown = (set(only or ()) | set(skip)) - set(NEEDS)
    if unknown:
        raise ValueError("unknown artefacts: " + ", ".join(sorted(unknown)))
    chosen = [n for n in NEEDS if (only is None or n in only) and n not in skip]
    forced = {d for n in chosen for d in NEEDS[n]}
    return [n for n in NEEDS if n in chosen or n in forced]


@dataclass
class Build:
    """The derived tables of a wide graph; each is a lazy DataFrame.

    ``roots`` gives the root concept of each dimension; ``vocabulary`` has (uri, broader).
    Samples without usable coordinates are in the base table, not in the derived ones.
    ``keep`` gives the stored table of a name, and has it made where there is none; builds
    that share it share their base tables.
    """

    wide: DataFrame
    vocabulary: DataFrame
    roots: dict[str, str]
    resolutions: Sequence[int] = field(default=RESOLUTIONS)
    keep: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None

    def _down(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A base table, written down once."""
        return self.keep(name, make) if self.keep else checkpointed(make())

    def check_input(self) -> None:
        """Ids and sample pids are present and single."""
        for rows, key in ((self.wide, "row_id"), (graph.of_type(self.wide, "MaterialSampleRecord"), "pid")):
            bad = quality.duplicates(rows, key).union(rows.filter(F.col(key).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))).limit(1).collect()  # one row
            if bad:
                raise ValueError(f"{key} is null or repeated, e.g. {bad[0][0]}")

    @cached_property
    def concepts(self) -> DataFrame:
        """(row_id, uri, label), in files of their own: the planner sees how small they are."""

        def make() -> DataFrame:
            return graph.of_type(self.wide, "IdentifiedConcept").select("row_id", F.col("pid").alias("uri"), "label")

        return self.keep("concepts", make) if self.keep else written(make(), "concepts")

    @cached_property
    def references(self) -> DataFrame:
        """(pid, dim, pos, uri): the known concepts of the samples, from one scan; dangling ids are passed over."""
        placed = lambda d: lambda x, k: F.struct(F.lit(d).alias("dim"), k.alias("pos"), x.alias("row_id"))
        each = [F.transform(F.coalesce(F.col(c).cast("array<bigint>"), F.array().cast("array<bigint>")), placed(d)) for d, c in REFERENCES.items()]
        rows = graph.of_type(self.wide, "MaterialSampleRecord").select("pid", F.explode(F.concat(*each)).alias("z")).select("pid", "z.*")
        return rows.join(self.concepts.select(F.col("row_id").cast("long").alias("row_id"), "uri"), "row_id").select("pid", "dim", "pos", "uri")

    def _first_real(self) -> DataFrame:
        """(pid, dimensions): of each the first concept that is not the root."""
        real = lambda d: (F.col("dim") == d) & (F.col("uri") != self.roots[d])
        return self.references.groupBy("pid").agg(*[ar.first_by(F.col("uri"), F.col("pos"), real(d)).alias(d) for d in DIMS])

    @cached_property
    def concept_labels(self) -> DataFrame:
        """(pid, concept_labels): the distinct labels of all concepts and keywords, in order."""
        cols = [c for c in (*REFERENCES.values(), KEYWORDS) if c in self.wide.columns]
        every = F.concat(*[F.coalesce(F.col(c).cast("array<bigint>"), F.array().cast("array<bigint>")) for c in cols])
        ids = graph.of_type(self.wide, "MaterialSampleRecord").select("pid", F.explode(every).alias("row_id"))
        named = self.concepts.filter(F.trim("label") != "").select("row_id", "label")
        return ids.join(named, "row_id").groupBy("pid").agg(ar.distinct_text(F.col("label")).alias("concept_labels"))

    @cached_property
    def samp(self) -> DataFrame:
        """All samples with what is known of them, labels included."""
        return self.known.join(self.concept_labels, "pid", "left")

    @cached_property
    def known(self) -> DataFrame:
        """All samples but their concepts' labels, which no derived table has; own values win unless null or empty."""
        ev = graph.of_type(self.wide, "SamplingEvent").select(F.col("row_id").alias("event_id"), F.col("result_time").cast("string").alias("ev_time"), ar.first(F.col("p__sampling_site")).alias("site_id"))
        st = graph.of_type(self.wide, "SamplingSite").select(F.col("row_id").alias("site_id"), F.col("place_name").alias("site_place"))
        s = graph.of_type(self.wide, "MaterialSampleRecord").withColumn("event_id", ar.first(F.col("p__produced_by"))).withColumn("own_time", F.col("result_time").cast("string"))
        s = s.join(ev, "event_id", "left").join(st, "site_id", "left")
        place = F.when(F.size("place_name") > 0, F.col("place_name")).otherwise(F.col("site_place"))
        time = F.when(F.trim("own_time") != "", F.col("own_time")).otherwise(F.col("ev_time"))
        pt = geo.point(F.col("geometry"))
        s = s.withColumn("pt", pt)
        out = s.select("pid", F.col("n").alias("source"), "label", "description", place.alias("place_name"), time.alias("result_time"), F.round("pt.y", 6).alias("latitude"), F.round("pt.x", 6).alias("longitude"))
        return out.join(self._first_real(), "pid", "left")

    @cached_property
    def samp_geo(self) -> DataFrame:
        """Located samples with their cell at each resolution; written down for the artefacts that read it."""

        def make() -> DataFrame:
            located = self.known.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            for r in self.resolutions:
                located = located.withColumn(f"h3_res{r}", geo.cell(F.col("latitude"), F.col("longitude"), r))
            return located

        return self._down("samp_geo", make)

    @cached_property
    def tree(self) -> DataFrame:
        t = self._down("tree", lambda: hierarchy.parents_of(self.vocabulary))
        cyclic = hierarchy.check_tree(t).limit(1).collect()  # one row
        if cyclic:
            raise ValueError(f"the vocabulary has a cycle at {cyclic[0][0]}")
        return t

    @cached_property
    def closed(self) -> DataFrame:
        return hierarchy.closure(self.tree)

    @cached_property
    def root_rows(self) -> DataFrame:
        return local(self.wide.sparkSession, list(self.roots.items()), facet_type=pa.string(), root_uri=pa.string())

    @cached_property
    def member(self) -> DataFrame:

        def make() -> DataFrame:
            asserted = self.references.select("pid", F.col("dim").alias("facet_type"), "uri").join(self.samp_geo.select("pid"), "pid", "left_semi")
            assigned = hierarchy.assign(self.closed, self.root_rows)
            depth = self.closed.groupBy("uri").agg((F.count(F.lit(1)) - 1).cast("int").alias("depth"))
            return hierarchy.membership(asserted, self.closed, assigned, self.root_rows, depth)

        return self._down("member", make)

    def unreachable(self) -> DataFrame:
        return hierarchy.unreachable(self.tree, hierarchy.assign(self.closed, self.root_rows))

    @cached_property
    def bits(self) -> DataFrame:
        b = self._down("bits", lambda: hierarchy.node_bits(hierarchy.tree_summaries(self.member, self.tree)))
        hierarchy.check_bits(b)
        return b

    @cached_property
    def ids(self) -> DataFrame:
        """One row: the ids that tie the artefacts of this build together."""
        return self._down("ids", lambda: hierarchy.build_ids(self.member, self.samp_geo))

    def table(self, name: str) -> DataFrame:
        """A derived table by name."""
        g = self.samp_geo
        one = F.broadcast(self.ids) if name in ("facet_node_bits", "sample_facet_masks", "sample_facet_index", "sample_facet_index_meta") else None  # one row
        if name == "sample_facets_v2":
            return g.select("pid", "source", *DIMS, "label", "description", F.to_json("place_name").alias("place_name"))
        if name == "samples_map_lite":
            cells = [f"h3_res{r}" for r in self.resolutions]
            return g.select("pid", "label", "source", "latitude", "longitude", "place_name", "result_time", *cells, geo.cell_hex(F.col(cells[-1])).alias(f"{cells[-1]}_hex"))
        if name.startswith("h3_summary_res"):
            r = int(name.removeprefix("h3_summary_res"))
            return clusters.cluster_summary(g, f"h3_res{r}", r)
        if name == "facet_summaries":
            return facets.summaries(g, FLAT)
        if name == "facet_cross_filter":
            return facets.cross_filter(g, FLAT)
        if name == "wide_h3":
            pt = geo.point(F.col("geometry"))
            out = self.wide.withColumn("_pt", pt)
            for r in self.resolutions:
                out = out.withColumn(f"h3_res{r}", geo.cell(F.col("_pt.y"), F.col("_pt.x"), r))
            return out.drop("_pt")
        if name == "sample_facet_membership":
            return self.member
        if name == "facet_tree_summaries":
            return hierarchy.tree_summaries(self.member, self.tree)
        if name == "facet_tree_cross_filter":
            return facets.tree_cross_filter(self.member, g, DIMS)
        if name == "facet_node_bits":
            return self.bits.crossJoin(one.select(F.col("membership_id").alias("build_id")))
        if name == "sample_facet_masks":
            return hierarchy.masks(self.member, self.bits, DIMS).crossJoin(one.select(F.col("membership_id").alias("build_id")))
        version = F.lit(hierarchy.SCHEMA_VERSION).cast("int").alias("schema_version")
        if name == "sample_facet_index":
            rows = hierarchy.index(g, hierarchy.masks(self.member, self.bits, DIMS), DIMS)
            return rows.crossJoin(one.select("build_id")).withColumn("schema_version", version)
        if name == "sample_facet_index_meta":
            rows = hierarchy.index_meta(g).crossJoin(one.select("build_id"))
            return rows.select("source", "count", "build_id", version, "total_rows")
        raise KeyError(name)

    def write(self, folder: str, only: Sequence[str] | None = None, skip: Sequence[str] = ()) -> list[str]:
        """Write the chosen artefacts, each in a total order; returns their names."""
        from ..sources import sinks

        self.check_input()
        order = {"facet_summaries": ("facet_type", "facet_value"), "wide_h3": ("row_id",), "sample_facet_index_meta": ("source",)}
        names = selection(only, skip)
        for n in names:
            df = self.table(n)
            keys = order.get(n) or (("pid",) if "pid" in df.columns else ("h3_cell",) if "h3_cell" in df.columns else tuple(c for c in df.columns if c not in ("count", "build_id", "scheme")))
            sinks.write(df, f"{folder}/{n}.parquet", *keys, single="pid" not in df.columns and n != "wide_h3")
        return names


def add_cells(lite: DataFrame, resolutions: Sequence[int] = RESOLUTIONS) -> DataFrame:
    """A map table with its cells derived anew from its rounded coordinates."""
    out = lite
    for r in resolutions:
        out = out.withColumn(f"h3_res{r}", geo.cell(F.col("latitude"), F.col("longitude"), r))
    return out


def geocodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(pid, latitude, longitude, location_type) of every place."""
    kinds = graph.classify_places(nodes, edges, keep_unused=True)
    g = graph.of_type(nodes, "GeospatialCoordLocation").withColumn("pt", geo.point(F.col("geometry")))
    return g.join(kinds, "row_id").select("pid", F.col("pt.y").alias("latitude"), F.col("pt.x").alias("longitude"), "location_type")
