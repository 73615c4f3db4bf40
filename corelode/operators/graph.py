"""The property graph in its two encodings, and the walks over it.

Wide: one row an entity, relations are arrays of row ids (``p__<predicate>``).
Narrow: relations are edge rows (s, p, o[]).  A walk explodes the arrays and joins
on equality; ``array_contains`` in a join condition would be a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import first

EDGE = "_edge_"
PREFIX = "p__"


def of_type(nodes: DataFrame, otype: str) -> DataFrame:
    return nodes.filter(F.col("otype") == otype)


def relations(wide: DataFrame) -> list[str]:
    """Columns that hold references: the name prefix and an array of integers."""
    return [n for n, t in wide.dtypes if n.startswith(PREFIX) and t in ("array<bigint>", "array<int>")]


def edges(narrow: DataFrame) -> DataFrame:
    """(s, p, o): one row for each target."""
    return of_type(narrow, EDGE).select("s", "p", F.explode("o").alias("o"))


def first_edges(narrow: DataFrame) -> DataFrame:
    """(s, p, o): the first target of each edge row only."""
    return of_type(narrow, EDGE).select("s", "p", first(F.col("o")).alias("o")).filter(F.col("o").isNotNull())


def wide_edges(wide: DataFrame, predicates: Sequence[str] | None = None) -> DataFrame:
    """(s, p, o) of a wide graph, in one pass over its relation columns."""
    cols = [c for c in relations(wide) if predicates is None or c[len(PREFIX) :] in predicates]
    def pairs(c: str):
        name = F.lit(c[len(PREFIX) :]).alias("p")
        return F.transform(F.coalesce(c, F.array().cast("array<bigint>")), lambda o: F.struct(name, o.cast("long").alias("o")))

    each = [pairs(c) for c in cols]
    return wide.select(F.col("row_id").cast("long").alias("s"), F.explode(F.concat(*each)).alias("e")).select("s", "e.p", "e.o")


def to_narrow(wide: DataFrame) -> DataFrame:
    """(row_id, pid, otype, s, p, o): nodes and edge rows; an array is one edge row."""
    nodes = wide.select(F.col("row_id").cast("long").alias("row_id"), "pid", "otype", F.lit(None).cast("long").alias("s"), F.lit(None).cast("string").alias("p"), F.lit(None).cast("array<bigint>").alias("o"))
    out = nodes
    for c in relations(wide):
        rows = wide.filter(F.size(c) > 0)
        out = out.unionByName(rows.select(F.lit(None).cast("long").alias("row_id"), F.concat_ws("|", "pid", F.lit(c)).alias("pid"), F.lit(EDGE).alias("otype"), F.col("row_id").cast("long").alias("s"), F.lit(c[len(PREFIX) :]).alias("p"), F.col(c).cast("array<bigint>").alias("o")))
    return out


def to_wide(narrow: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Nodes with one array a predicate: the targets of all its edge rows."""
    e = of_type(narrow, EDGE).groupBy("s").pivot("p", list(predicates)).agg(F.flatten(F.collect_list("o")))
    e = e.select(F.col("s").alias("row_id"), *[F.col(p).alias(PREFIX + p) for p in predicates])
    return narrow.filter(F.col("otype") != EDGE).select("row_id", "pid", "otype").join(e, "row_id", "left")


def hop(rows: DataFrame, e: DataFrame, predicate: str | Sequence[str], at: str, to: str) -> DataFrame:
    """``rows`` joined along a predicate: the id in ``at`` leads to ids in ``to``."""
    ps = [predicate] if isinstance(predicate, str) else list(predicate)
    step = e.filter(F.col("p").isin(ps)).select(F.col("s").alias(at), F.col("o").alias(to))
    return rows.join(step, at)


def back(rows: DataFrame, e: DataFrame, predicate: str, at: str, to: str) -> DataFrame:
    """The reverse: the id in ``at`` is a target, its subjects are in ``to``."""
    step = e.filter(F.col("p") == predicate).select(F.col("o").alias(at), F.col("s").alias(to))
    return rows.join(step, at)


def direct_path(nodes: DataFrame, e: DataFrame, sample: str = "MaterialSampleRecord") -> DataFrame:
    """(sample, event, geo): sample, its event, the event's own place."""
    s = of_type(nodes, sample).select(F.col("row_id").alias("sample"))
    return hop(hop(s, e, "produced_by", "sample", "event"), e, "sample_location", "event", "geo").withColumn("location_path", F.lit("direct_event_location"))


def site_path(nodes: DataFrame, e: DataFrame, sample: str = "MaterialSampleRecord") -> DataFrame:
    """(sample, event, site, geo): sample, its event, the event's site, the site's place."""
    s = of_type(nodes, sample).select(F.col("row_id").alias("sample"))
    out = hop(hop(s, e, "produced_by", "sample", "event"), e, "sampling_site", "event", "site")
    return hop(out, e, "site_location", "site", "geo").withColumn("location_path", F.lit("via_site_location"))


def samples_at(nodes: DataFrame, e: DataFrame, geo_pid: str, *, via_site: bool = False) -> DataFrame:
    """Samples of a place, walked backwards from it."""
    at = nodes.filter(F.col("pid") == geo_pid).select(F.col("row_id").alias("geo"))
    events = back(back(at, e, "site_location", "geo", "site"), e, "sampling_site", "site", "event") if via_site else back(at, e, "sample_location", "geo", "event")
    found = back(events, e, "produced_by", "event", "row_id").select("row_id").distinct()
    return nodes.join(found, "row_id", "left_semi")


def sample_card(nodes: DataFrame, e: DataFrame, pid: str) -> DataFrame:
    """(sample, event, geo, site): what a sample's card needs; both place and site must exist."""
    s = nodes.filter(F.col("pid") == pid).select(F.col("row_id").alias("sample"))
    out = hop(s, e, "produced_by", "sample", "event")
    return hop(hop(out, e, "sample_location", "event", "geo"), e, "sampling_site", "event", "site")


def agents_narrow(nodes: DataFrame, e: DataFrame, pid: str) -> DataFrame:
    """Agents of the event of a sample, by either role."""
    s = nodes.filter(F.col("pid") == pid).select(F.col("row_id").alias("sample"))
    events = hop(s, e, "produced_by", "sample", "event")
    step = e.filter(F.col("p").isin("responsibility", "registrant")).select(F.col("s").alias("event"), F.col("p").alias("predicate"), F.col("o").alias("agent"))
    return events.join(step, "event").select("agent", "predicate")


def agents_wide(nodes: DataFrame, e: DataFrame, pid: str) -> DataFrame:
    """Agents responsible for the event, and the registrant of the sample itself."""
    s = nodes.filter(F.col("pid") == pid).select(F.col("row_id").alias("sample"))
    a = hop(hop(s, e, "produced_by", "sample", "event"), e, "responsibility", "event", "agent").select("agent", F.lit("responsibility").alias("predicate"))
    b = hop(s, e, "registrant", "sample", "agent").select("agent", F.lit("registrant").alias("predicate"))
    return a.unionByName(b)


def concepts(nodes: DataFrame, e: DataFrame, pid: str, predicates: Sequence[str]) -> DataFrame:
    """(predicate, concept) of a sample."""
    s = nodes.filter(F.col("pid") == pid).select(F.col("row_id").alias("s"))
    return e.filter(F.col("p").isin(list(predicates))).join(s, "s").select(F.col("p").alias("predicate"), F.col("o").alias("concept"))


def used_by(wide: DataFrame, row_id: int, predicates: Sequence[str] | None = None) -> DataFrame:
    """Rows that refer to an id: a literal, so containment is a filter."""
    hit = F.lit(False)
    for c in relations(wide):
        if predicates is None or c[len(PREFIX) :] in predicates:
            hit = hit | F.coalesce(F.array_contains(c, F.lit(row_id).cast(dict(wide.dtypes)[c][6:-1])), F.lit(False))
    return wide.filter(hit)


def classify_places(nodes: DataFrame, e: DataFrame, *, keep_unused: bool = False, place: str = "GeospatialCoordLocation") -> DataFrame:
    """(row_id, location_type): how each place is used.

    Without ``keep_unused`` places that nothing refers to are absent, as where edges
    are rows; with it they stay with a null type, as where edges are arrays.
    """
    use = e.groupBy(F.col("o").alias("row_id")).agg(F.max((F.col("p") == "sample_location").cast("int")).alias("a"), F.max((F.col("p") == "site_location").cast("int")).alias("b"))
    g = of_type(nodes, place).select("row_id").join(use, "row_id", "left" if keep_unused else "inner")
    kind = F.when((F.col("a") == 1) & (F.col("b") == 1), "both").when(F.col("a") == 1, "sample_location_only").when(F.col("b") == 1, "site_location_only")
    return g.select("row_id", kind.alias("location_type"))


def path_coverage(nodes: DataFrame, e: DataFrame) -> DataFrame:
    """(location_path, samples): distinct samples that each path reaches."""
    a = direct_path(nodes, e).groupBy("location_path").agg(F.count_distinct("sample").alias("samples"))
    b = site_path(nodes, e).groupBy("location_path").agg(F.count_distinct("sample").alias("samples"))
    return a.unionByName(b)


def first_location(wide: DataFrame) -> DataFrame:
    """(row_id, event_id, site_id) by first references: null, not an error, where there is none."""
    ev = of_type(wide, "SamplingEvent").select(F.col("row_id").alias("event_id"), first(F.col("p__sampling_site")).alias("site_id"))
    s = of_type(wide, "MaterialSampleRecord").select("row_id", first(F.col("p__produced_by")).alias("event_id"))
    return s.join(ev, "event_id", "left").select("row_id", "event_id", "site_id")
