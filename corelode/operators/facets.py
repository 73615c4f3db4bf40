"""Facet counts: summaries, cubes, the index path and the router between them.

Everything that the classical form writes as a union of scans is one pass here:
dimensions are stacked or exploded from the row itself and counted together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import not_blank
from ..lineage import local
from . import filters as fl
from .filters import FilterState

FILTERS = "filter_"


def _pairs(dims: Sequence[str]) -> Column:
    """Array of (dimension, value) of a row, blanks left out."""
    each = F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).cast("string").alias("v")) for d in dims])
    return F.filter(each, lambda z: z["v"].isNotNull() & (F.trim(z["v"]) != ""))


def summaries(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(facet_type, facet_value, scheme, count): one scan for all dimensions."""
    rows = df.select(F.explode(_pairs(dims)).alias("z"))
    out = rows.groupBy(F.col("z.d").alias("facet_type"), F.col("z.v").alias("facet_value")).agg(F.count(F.lit(1)).alias("count"))
    return out.select("facet_type", "facet_value", F.lit(None).cast("int").alias("scheme"), "count")


def _cube(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts of (f, t) pairs, or sums of their n, in the layout of the cubes: one filter column set, or none."""
    out = rows.groupBy("f", "t").agg((F.sum("n") if "n" in rows.columns else F.count(F.lit(1))).alias("count"))
    set_ = [F.when(F.col("f.d") == d, F.col("f.v")).alias(f"{FILTERS}{d}") for d in dims]
    return out.select(*set_, F.col("t.d").alias("facet_type"), F.col("t.v").alias("facet_value"), "count")


def cross_filter(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Counts of every value under every single filter, the filtered dimension included, and under none.

    Rows of equal values are counted first.  Two explodes of such a row's own few values
    then replace a scan for each pair of dimensions.
    """
    none = F.struct(F.lit(None).cast("string").alias("d"), F.lit(None).cast("string").alias("v"))
    p = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n")).select(_pairs(dims).alias("p"), "n")
    rows = p.select(F.explode(F.concat(F.array(none), "p")).alias("f"), "p", "n").select("f", F.explode("p").alias("t"), "n")
    return _cube(rows, dims)


def tree_cross_filter(member: DataFrame, samples: DataFrame, dims: Sequence[str], key: str = "pid") -> DataFrame:
    """The cube over tree nodes and the flat source: other dimensions only, and the baseline.

    The nodes of a sample are gathered once and paired inside the row, which
    shuffles membership once instead of joining it to itself.
    """
    flat = samples.filter(not_blank(F.col("source"))).select(key, F.struct(F.lit("source").alias("d"), F.col("source").alias("v")).alias("z"))
    nodes = member.select(key, F.struct(F.col("facet_type").alias("d"), F.col("concept_uri").alias("v")).alias("z"))
    per = nodes.union(flat).groupBy(key).agg(F.collect_list("z").alias("p"))
    none = F.struct(F.lit(None).cast("string").alias("d"), F.lit(None).cast("string").alias("v"))
    rows = per.select(F.explode(F.concat(F.array(none), "p")).alias("f"), "p").select("f", F.explode("p").alias("t"))
    return _cube(rows.filter(F.col("f.d").isNull() | (F.col("f.d") != F.col("t.d"))), ["source", *dims])


def bit_counts(index: DataFrame, bits: DataFrame, dim: str) -> DataFrame:
    """(facet_type, facet_value, count) of a tree dimension from its masks: one pass, no theta join."""
    m = F.col(f"{dim}_mask")
    on = F.filter(F.sequence(F.lit(0), F.lit(fl.MAX_BITS - 1)), lambda b: F.getbit(m, b) == 1)
    n = index.filter(m != 0).select(F.explode(on).alias("bit_index")).groupBy("bit_index").agg(F.count(F.lit(1)).alias("count"))
    names = F.broadcast(bits.filter(F.col("facet_type") == dim).select("bit_index", F.col("concept_uri").alias("facet_value")))
    return n.join(names, "bit_index").select(F.lit(dim).alias("facet_type"), "facet_value", "count")


@dataclass
class Tables:
    """What the counting paths read.  Cubes and index may be missing."""

    samples: DataFrame
    membership: DataFrame | None = None
    bits: DataFrame | None = None
    index: DataFrame | None = None
    tree_cube: DataFrame | None = None
    flat_cube: DataFrame | None = None
    known_sources: tuple[str, ...] = ()
    dims: tuple[str, ...] = ("material", "context", "object_type")
    key: str = "pid"
    node_bits: Mapping[tuple[str, str], int] | None = None


def index_counts(t: Tables, state: FilterState) -> DataFrame:
    """Counts of every dimension over the index, each without its own filter.

    One pass: the rows that pass box and search are counted by source, with a counter
    for every node (at most 63 a dimension) of the rows that pass the other dimensions.
    With no source chosen, the tree dimensions count nothing.
    """
    base = t.index
    if state.bbox is not None:
        near = t.samples.filter(state.bbox.where(F.col("latitude"), F.col("longitude"))).select(t.key)
        base = base.join(near, t.key, "left_semi")
    base = fl.in_search(base, state.search, t.key)
    nodes = t.node_bits or {}
    chosen = fl.node_masks({d: v for d, v in state.nodes.items() if v}, nodes)
    if chosen is None:
        raise ValueError("a chosen node has no bit")
    src = fl.source_where(state.sources, t.known_sources, F.col("source"))
    listed = sorted((d, uri, bit) for (d, uri), bit in nodes.items() if d in t.dims)
    for d in t.dims:
        base = base.withColumn(f"_pass_{d}", src & fl.mask_where({k: v for k, v in chosen.items() if k != d}))
    # as text: a column a call would cost more than the counting
    counters = [F.expr(f"count_if(`_pass_{d}` AND getbit(`{d}_mask`, {bit}) = 1)").alias(f"n{k}") for k, (d, _, bit) in enumerate(listed)]
    by = base.groupBy("source").agg(F.count_if(fl.mask_where(chosen)).alias("n"), *counters)
    # place 0 is the source's own count; it has a row a source, every node one in all
    each = by.select("source", F.expr(f"posexplode(array({', '.join(['n', *(f'n{k}' for k in range(len(listed)))])})) as (k, n)")).filter("n > 0 and (k > 0 or source is not null)")
    sums = each.groupBy("k", F.when(F.col("k") == 0, F.col("source")).alias("own")).agg(F.sum("n").alias("count"))
    names = local(t.index.sparkSession, [(0, "source", None), *((k + 1, d, uri) for k, (d, uri, _) in enumerate(listed))], k=pa.int32(), facet_type=pa.string(), node=pa.string())
    return sums.join(F.broadcast(names), "k").select("facet_type", F.coalesce("own", "node").alias("facet_value"), "count")  # a row a node


def slow_counts(t: Tables, state: FilterState) -> DataFrame:
    """The same counts from samples and membership, for any state."""
    out: DataFrame | None = None
    for d in ("source", *t.dims):
        seen = fl.apply(t.samples, state.without(d), t.known_sources, membership=t.membership, key=t.key)
        if d == "source":
            n = seen.filter(F.col("source").isNotNull()).groupBy(F.col("source").alias("facet_value")).agg(F.count(F.lit(1)).alias("count"))
        else:
            m = t.membership.filter(F.col("facet_type") == d).join(seen.select(t.key), t.key, "left_semi")
            n = m.groupBy(F.col("concept_uri").alias("facet_value")).agg(F.count_distinct(t.key).alias("count"))
        n = n.select(F.lit(d).alias("facet_type"), "facet_value", "count")
        out = n if out is None else out.unionByName(n)
    return out


def flat_counts(df: DataFrame, state: FilterState, dims: Sequence[str], known_sources: Sequence[str], key: str = "pid") -> DataFrame:
    """Counts of flat dimensions, each without its own filter, in one scan of the filtered base.

    A row counts for a dimension when it passes all the other ones.
    """
    base = df
    if state.bbox is not None:
        base = base.filter(state.bbox.where(F.col("latitude"), F.col("longitude")))
    base = fl.in_search(base, state.search, key)
    passes = {d: F.col(d).isin(sorted(state.values[d])) if state.values.get(d) else F.lit(True) for d in dims if d != "source"}
    passes["source"] = fl.source_where(state.sources, known_sources, F.col("source"))
    each = []
    for d in dims:
        ok = F.lit(True)
        for other, p in passes.items():
            if other != d:
                ok = ok & p
        v = F.col(d).cast("string")
        each.append(F.struct(F.lit(d).alias("d"), v.alias("v"), (F.coalesce(ok, F.lit(False)) & not_blank(v)).alias("ok")))
    rows = base.select(F.explode(F.filter(F.array(*each), lambda z: z["ok"])).alias("z"))
    return rows.groupBy(F.col("z.d").alias("facet_type"), F.col("z.v").alias("facet_value")).agg(F.count(F.lit(1)).alias("count"))


def cube_slice(cube: DataFrame, dim: str | None, value: str | None) -> DataFrame:
    """Rows of a cube with exactly one filter set (or none): the counts under that filter."""
    out = cube
    for c in [c for c in cube.columns if c.startswith(FILTERS)]:
        out = out.filter(F.col(c) == value) if c == f"{FILTERS}{dim}" else out.filter(F.col(c).isNull())
    return out.select("facet_type", "facet_value", "count")


def own_dimension(t: Tables, dim: str) -> DataFrame:
    """Baseline counts of one dimension, which a single filter on it leaves unchanged."""
    return cube_slice(t.tree_cube, None, None).filter(F.col("facet_type") == dim)


def route(t: Tables, state: FilterState, *, global_view: bool = True) -> tuple[str, DataFrame]:
    """(tier, counts): the cheapest path that gives the exact answer."""
    active = state.active
    restricted = state.sources is not None and not set(t.known_sources) <= set(state.sources)
    plain = (global_view or state.bbox is None) and state.search is None and not state.terms
    picks = [a for a in active if a[0] != "source"] if not restricted else active
    if plain and t.tree_cube is not None and not any(state.values.values()) and len(picks) == 1 and state.sources != frozenset():
        dim, value = picks[0]
        return "tree_cube", cube_slice(t.tree_cube, dim, value).unionByName(own_dimension(t, dim))
    if plain and t.tree_cube is not None and not picks and not restricted:
        return "baseline", cube_slice(t.tree_cube, None, None)
    if t.index is not None and t.bits is not None and not state.terms and not any(state.values.values()):
        if fl.node_masks({d: v for d, v in state.nodes.items() if v}, t.node_bits or {}) is not None:
            return "index", index_counts(t, state)
        if state.bbox is None and t.membership is None:
            return "unavailable", t.samples.sparkSession.createDataFrame([], "facet_type string, facet_value string, count long")
    return "slow", slow_counts(t, state)


def display_counts(counts: Mapping[str, int] | None, values: Sequence[str], baseline: Mapping[str, int]) -> dict[str, int]:
    """None shows the baseline; a map shows its counts, and zero for values it lacks."""
    return {v: baseline.get(v, 0) for v in values} if counts is None else {v: counts.get(v, 0) for v in values}
