"""Composable filters: one immutable state, one predicate or semi-join for each part.

A :class:`FilterState` is what a user has chosen.  Inside a dimension choices are
OR-ed, dimensions are AND-ed, and a facet count leaves its own dimension out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.geo import BBox

MAX_BITS = 63


@dataclass(frozen=True)
class FilterState:
    """``sources`` None: all; empty: none.  ``nodes``: chosen tree nodes by dimension."""

    sources: frozenset[str] | None = None
    nodes: Mapping[str, frozenset[str]] = field(default_factory=dict)
    values: Mapping[str, frozenset[str]] = field(default_factory=dict)
    bbox: BBox | None = None
    terms: tuple[str, ...] = ()
    search: DataFrame | None = field(default=None, compare=False)

    def without(self, dim: str) -> FilterState:
        """The state that the facet counts of ``dim`` see."""
        if dim == "source":
            return replace(self, sources=None)
        return replace(self, nodes={k: v for k, v in self.nodes.items() if k != dim}, values={k: v for k, v in self.values.items() if k != dim})

    @property
    def active(self) -> list[tuple[str, str]]:
        """(dimension, value) of every choice."""
        out = [("source", s) for s in sorted(self.sources or ())]
        for group in (self.nodes, self.values):
            out += [(d, v) for d in sorted(group) for v in sorted(group[d])]
        return out

    def signature(self) -> str:
        """A key for caches: equal for equal choices in any order."""
        box = "" if self.bbox is None else f"{self.bbox.south},{self.bbox.west},{self.bbox.north},{self.bbox.east}"
        src = "*" if self.sources is None else ",".join(sorted(self.sources))
        return "|".join([src, ";".join(f"{d}={v}" for d, v in self.active if d != "source"), box, " ".join(self.terms)])


def source_where(chosen: Sequence[str] | frozenset[str] | None, known: Sequence[str], col: Column) -> Column:
    """No source chosen accepts nothing, all of the known ones (or None) everything, nulls too."""
    if chosen is None or set(known) <= set(chosen):
        return F.lit(True)
    return col.isin(sorted(chosen)) if chosen else F.lit(False)


def minimal_selection(chosen: set[str], parents: Mapping[str, str | None]) -> set[str]:
    """The chosen nodes none of whose ancestors is chosen."""
    out = set()
    for node in chosen:
        seen, up = {node}, parents.get(node)
        while up is not None and up not in seen and up not in chosen:
            seen.add(up)
            up = parents.get(up)
        if up is None or up in seen:
            out.add(node)
    return out


def node_masks(nodes: Mapping[str, frozenset[str]], bits: Mapping[tuple[str, str], int]) -> dict[str, int] | None:
    """Mask per dimension; None when a node has no bit, so that nothing is matched by mistake."""
    out: dict[str, int] = {}
    for dim, chosen in nodes.items():
        if not chosen:
            continue
        mask = 0
        for uri in chosen:
            if (dim, uri) not in bits:
                return None
            mask |= 1 << bits[dim, uri]
        if not mask:
            return None
        out[dim] = mask
    return out


def mask_where(masks: Mapping[str, int]) -> Column:
    """Rows whose mask shares a bit with the chosen mask in every dimension."""
    out = F.lit(True)
    for dim, mask in masks.items():
        out = out & (F.col(f"{dim}_mask").bitwiseAND(F.lit(mask).cast("long")) != 0)
    return out


def by_masks(df: DataFrame, masks_table: DataFrame, masks: Mapping[str, int], key: str = "pid") -> DataFrame:
    return df if not masks else df.join(masks_table.filter(mask_where(masks)).select(key), key, "left_semi")


def division(membership: DataFrame, nodes: Mapping[str, frozenset[str]], key: str = "pid") -> DataFrame:
    """Keys that have one of the chosen nodes in every dimension (relational division)."""
    nodes = {d: v for d, v in nodes.items() if v}
    wanted = F.lit(False)
    for dim, uris in nodes.items():
        wanted = wanted | ((F.col("facet_type") == dim) & F.col("concept_uri").isin(sorted(uris)))
    return membership.filter(wanted).groupBy(key).agg(F.count_distinct("facet_type").alias("n")).filter(F.col("n") == len(nodes)).select(key)


def by_membership(df: DataFrame, membership: DataFrame, nodes: Mapping[str, frozenset[str]], key: str = "pid") -> DataFrame:
    return df.join(division(membership, nodes, key), key, "left_semi") if any(nodes.values()) else df


def by_values(values: Mapping[str, frozenset[str]]) -> Column:
    """Flat facet choices on the facet columns themselves."""
    out = F.lit(True)
    for dim, chosen in values.items():
        if chosen:
            out = out & F.col(dim).isin(sorted(chosen))
    return out


def in_search(df: DataFrame, found: DataFrame | None, key: str = "pid") -> DataFrame:
    """Rows of the current search; the handle is a DataFrame, nothing is mutated."""
    return df if found is None else df.join(found.select(key).distinct(), key, "left_semi")


def apply(df: DataFrame, state: FilterState, known_sources: Sequence[str], *, membership: DataFrame | None = None, key: str = "pid", lat: str = "latitude", lng: str = "longitude", text_cols: Sequence[str] = ("label", "description")) -> DataFrame:
    """All parts of a state at once."""
    out = df.filter(source_where(state.sources, known_sources, F.col("source")))
    if any(state.values.values()):
        out = out.filter(by_values(state.values))
    if state.bbox is not None:
        out = out.filter(state.bbox.where(F.col(lat), F.col(lng)))
    if state.terms:
        out = out.filter(tx.text_where(state.terms, [F.col(c) for c in text_cols]))
    if any(state.nodes.values()):
        if membership is None:
            raise ValueError("tree choices need the membership table")
        out = by_membership(out, membership, state.nodes, key)
    return in_search(out, state.search, key)


def concept_rank(uri: str, material: str = "material", object_type: str = "object_type", context: str = "context") -> Column:
    """3, 2 or 1 for the column that holds the concept; null where none does."""
    w = F.when(F.col(material) == uri, 3)
    return w.when(F.col(object_type) == uri, 2).when(F.col(context) == uri, 1)


def described_by(df: DataFrame, uri: str, **cols: str) -> DataFrame:
    rank = concept_rank(uri, **cols)
    return df.filter(rank.isNotNull()).withColumn("relevance_score", rank)


def timestamp(col: Column) -> Column:
    """A timestamp from either type it comes in; null where it is none."""
    return col.try_cast("timestamp")


def in_time(col: Column, start: str, end: str) -> Column:
    return timestamp(col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def hash_sample(df: DataFrame, key: str, modulus: int, limit: int | None = None) -> DataFrame:
    """About one row in ``modulus``, the same rows each time."""
    out = df.filter(F.pmod(F.xxhash64(key), F.lit(modulus)) == 0)
    return out if limit is None else out.orderBy(key).limit(limit)


def bernoulli_sample(df: DataFrame, share: float, seed: int, limit: int | None = None, key: str = "pid") -> DataFrame:
    """Each row with the same chance; a limit takes the first by key."""
    out = df.sample(False, share, seed)
    return out if limit is None else out.orderBy(key).limit(limit)


def confident(df: DataFrame, confidence: str, least: float) -> DataFrame:
    """Rows whose classification is at least as sure; one without a confidence is not."""
    return df.filter(F.col(confidence) >= least)


def in_cells(df: DataFrame, cells: DataFrame, cell: str) -> DataFrame:
    """Rows in a set of cells: a superset of the rows of the box that the cells touch."""
    return df.join(cells.select(cell).distinct(), cell, "left_semi")


def scheme_of(pid: Column, schemes: Sequence[str] = ("igsn:", "ark:", "doi:")) -> Column:
    """Class of an identifier by its prefix."""
    out = None
    for s in schemes:
        hit = pid.startswith(s)
        out = F.when(hit, s.rstrip(":")) if out is None else out.when(hit, s.rstrip(":"))
    return F.lit("other") if out is None else out.otherwise("other")


NEAR_DEGREES = {4: 2.0, 6: 0.5, 8: 0.1}


def near_cluster(df: DataFrame, lat: float, lng: float, resolution: int, limit: int = 30, key: str = "pid") -> DataFrame:
    """Samples in the window around a cluster centre, the first by key (so the choice is repeatable)."""
    d = NEAR_DEGREES[resolution]
    return df.filter(F.col("latitude").between(lat - d, lat + d) & F.col("longitude").between(lng - d, lng + d)).orderBy(key).limit(limit)


def exists(df: DataFrame, where: Column) -> bool:
    return not df.filter(where).limit(1).isEmpty()


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value)).limit(1)
