"""Enrichment and synchronisation of a wide graph with an external one.

Every job checks its inputs and accounts for its output before anything replaces a
table; a violated rule raises :class:`SyncError`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrays as ar
from ..lineage import checkpointed
from . import graph

SAMPLE, CONCEPT = "MaterialSampleRecord", "IdentifiedConcept"
MAX_PASSES = 64


class SyncError(ValueError):
    """A rule of a job does not hold."""


def require_unique(df: DataFrame, key: str, what: str) -> None:
    bad = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull()).limit(5).collect()  # five rows
    if bad:
        raise SyncError(f"{what}: {key} is null or repeated: " + ", ".join(str(r[0]) for r in bad))


def require_none(df: DataFrame, what: str) -> None:
    rows = df.limit(5).collect()  # five rows
    if rows:
        raise SyncError(f"{what}: " + "; ".join(str(tuple(r)) for r in rows))


# minting:


def mint(new: DataFrame, start: int, *order: str, name: str = "row_id") -> DataFrame:
    """``new`` (distinct by ``order``) with ids after ``start`` in that order.

    Rows are range-partitioned by the order; a partition needs only the number of rows
    before it, so there is no single-partition window.  Equal input gives equal ids.
    """
    spark = new.sparkSession
    parts = new.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    parts = checkpointed(parts.withColumn("_p", F.spark_partition_id()))
    counts = {r["_p"]: r["n"] for r in parts.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    before, at = {}, start
    for p in sorted(counts):
        before[p] = at
        at += counts[p]
    if not before:
        return new.withColumn(name, F.lit(None).cast("long")).limit(0)
    base = F.create_map(*[F.lit(x) for p, v in before.items() for x in (p, v)])
    w = Window.partitionBy("_p").orderBy(*order)
    return parts.withColumn(name, (base[F.col("_p")] + F.row_number().over(w)).cast("long")).drop("_p")


def next_id(*tables: DataFrame) -> int:
    return max(int(t.agg(F.coalesce(F.max("row_id"), F.lit(0))).first()[0]) for t in tables)


# overlays:


def overlay_column(df: DataFrame, lookup: DataFrame, key: str, col: str) -> DataFrame:
    """``df`` with ``col`` from the lookup where it has one; the first in order if it has several."""
    one = lookup.filter(F.col(col).isNotNull()).groupBy(key).agg(F.min(col).alias("_new"))
    return df.join(one, key, "left").withColumn(col, F.coalesce("_new", col)).drop("_new").select(*df.columns)


def overlay_where(df: DataFrame, lookup: DataFrame, key: str, col: str, where) -> DataFrame:
    """The same for rows of one kind; all others, those with nulls in the condition too, stay."""
    one = lookup.groupBy(key).agg(F.min(col).alias("_new"))
    out = df.join(one, key, "left").withColumn(col, F.when(F.coalesce(where, F.lit(False)) & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(col)))
    return out.drop("_new").select(*df.columns)


def concept_overlay(ours: DataFrame, theirs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``ours`` with the concept arrays of matching samples replaced by theirs.

    Theirs win always; order is kept, an empty array is null.  URIs keep the smallest of
    our ids; unknown ones are minted after the largest, in URI order.
    """
    require_unique(ours, "row_id", "ours")
    require_unique(theirs.filter(F.col("otype") == SAMPLE), "pid", "theirs")
    require_unique(theirs, "row_id", "theirs")
    named = graph.of_type(theirs, CONCEPT).select(F.col("row_id").cast("long").alias("old_id"), F.col("pid").alias("uri"))
    shared = graph.of_type(ours, SAMPLE).select("pid")
    mine = graph.of_type(theirs, SAMPLE).join(shared, "pid", "left_semi")
    flat = None
    for c in columns:
        rows = mine.select("pid", F.lit(c).alias("col"), F.posexplode(F.col(c).cast("array<bigint>")).alias("pos", "old_id"))
        flat = rows if flat is None else flat.unionByName(rows)
    used = flat.join(named, "old_id", "left")
    require_none(used.filter("uri is null").select("pid", "col", "old_id"), "theirs: unresolved concept")
    known = graph.of_type(ours, CONCEPT).groupBy(F.col("pid").alias("uri")).agg(F.min(F.col("row_id").cast("long")).alias("new_id"))
    fresh = mint(used.select("uri").distinct().join(known, "uri", "left_anti"), next_id(ours), "uri", name="new_id")
    ids = known.unionByName(fresh.select("uri", "new_id"))
    lists = used.join(ids, "uri").groupBy("pid", "col").agg(ar.ordered_list(F.col("new_id"), F.col("pos")).alias("list"))
    wide = lists.groupBy("pid").pivot("col", list(columns)).agg(F.first("list")).select("pid", *[F.col(c).alias(f"_n_{c}") for c in columns])
    hit = mine.select("pid", F.lit(True).alias("_hit"))
    out = ours.join(hit, "pid", "left").join(wide, "pid", "left")
    take = F.coalesce("_hit", F.lit(False)) & (F.col("otype") == SAMPLE)
    for c in columns:
        out = out.withColumn(c, F.when(take, F.col(f"_n_{c}")).otherwise(F.col(c).cast("array<bigint>")))
    out = out.select(*ours.columns)
    facts = [c for c in ("label", "scheme_name", "scheme_uri") if c in theirs.columns and c in ours.columns]
    about = graph.of_type(theirs, CONCEPT).groupBy(F.col("pid").alias("uri")).agg(*[F.min(c).alias(c) for c in facts]) if facts else named.select("uri").distinct()
    rows = fresh.join(about, "uri").select(F.col("new_id").alias("row_id"), F.col("uri").alias("pid"), F.lit(CONCEPT).alias("otype"), *facts)
    return out.unionByName(conform(rows, ours))


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` in the schema of another table: columns in its order, cast, typed nulls where missing."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema.fields])


# true synchronisation:


def difference(ours: DataFrame, theirs: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(removed, added) sample pids of a source; a pid that another source has already is a collision."""
    mine = graph.of_type(ours, SAMPLE)
    have = mine.filter(F.col("n").eqNullSafe(F.lit(source))).select("pid")
    want = graph.of_type(theirs, SAMPLE).select("pid")
    removed, added = have.subtract(want), want.subtract(have)
    require_none(added.join(mine.filter(~F.col("n").eqNullSafe(F.lit(source))).select("pid"), "pid", "left_semi"), "pids of another source")
    return removed, added


def orphans(wide: DataFrame, removed: DataFrame, kept_types: Sequence[str] = (SAMPLE, CONCEPT)) -> DataFrame:
    """(row_id): the removed samples with all that only they held on to.

    A row goes when something that goes refers to it and nothing that stays does; the
    set grows until it is stable.  Samples and concepts are never dragged along.
    """
    e = checkpointed(graph.wide_edges(wide).select("s", "o").distinct())
    may_go = wide.filter(~F.col("otype").isin(list(kept_types))).select(F.col("row_id").cast("long").alias("o"))
    front = checkpointed(graph.of_type(wide, SAMPLE).join(removed, "pid", "left_semi").select(F.col("row_id").cast("long").alias("row_id")))
    gone = front
    # how many rows hold on to each row that may be dragged along
    held = None
    for _ in range(MAX_PASSES):
        lost = e.join(front.withColumnRenamed("row_id", "s"), "s", "left_semi").groupBy("o").agg(F.count(F.lit(1)).alias("lost"))
        lost = checkpointed(lost.join(may_go, "o", "left_semi"))
        if lost.isEmpty():
            return gone
        # only rows that lose a holder are counted, once each
        fresh = lost if held is None else lost.join(held, "o", "left_anti")
        n = e.join(fresh.select("o"), "o", "left_semi").groupBy("o").agg(F.count(F.lit(1)).alias("left"))
        held = n if held is None else held.unionByName(n)
        held = checkpointed(held.join(lost, "o", "left").select("o", (F.col("left") - F.coalesce("lost", F.lit(0))).alias("left")))
        front = checkpointed(held.filter("left = 0").select(F.col("o").alias("row_id")).join(gone, "row_id", "left_anti"))
        if front.isEmpty():
            return gone
        gone = checkpointed(gone.unionByName(front))
    raise SyncError("the removal did not settle")


def subgraph(theirs: DataFrame, added: DataFrame) -> DataFrame:
    """(row_id): the new samples and all they lead to, concepts apart (those are matched by URI)."""
    e = graph.wide_edges(theirs)
    samples = graph.of_type(theirs, SAMPLE).join(added, "pid", "left_semi").select(F.col("row_id").cast("long").alias("row_id"))
    inside = theirs.filter(~F.col("otype").isin(SAMPLE, CONCEPT)).select(F.col("row_id").cast("long").alias("row_id"))
    found, front = samples, samples
    for _ in range(3):  # sample, event, site, place
        step = e.join(front.withColumnRenamed("row_id", "s"), "s", "left_semi").select(F.col("o").alias("row_id")).distinct().join(inside, "row_id", "left_semi")
        front = step
        found = found.union(step)
    return found.distinct()


def remap_columns(rows: DataFrame, mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with every reference column translated by (old_id, new_id), in order; a lost reference raises.

    The columns are exploded together, so all of them cost one join.
    """
    each = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("array<bigint>").alias("a")) for c in columns])
    flat = rows.select("row_id", F.explode(each).alias("z")).select("row_id", F.col("z.c").alias("c"), F.posexplode("z.a").alias("pos", "old_id"))
    hit = checkpointed(flat.join(mapping, "old_id", "left"))
    require_none(hit.filter("new_id is null").select("row_id", "c", "old_id"), "references without a target")
    lists = hit.groupBy("row_id", "c").agg(ar.ordered_list(F.col("new_id"), F.col("pos")).alias("list"))
    wide = lists.groupBy("row_id").pivot("c", list(columns)).agg(F.first("list"))
    return rows.drop(*columns).join(wide, "row_id", "left").select(*rows.columns)


def true_sync(ours: DataFrame, theirs: DataFrame, source: str, points: DataFrame | None = None) -> DataFrame:
    """Our graph with one source made equal to theirs.

    Stale samples go with what only they used; new samples come with their subgraph under
    new ids; concepts are matched by URI and minted where unknown; every other row is
    untouched.  ``points`` (pid, latitude, longitude) fills coordinates of new places.
    """
    require_unique(ours, "row_id", "ours")
    require_unique(theirs, "row_id", "theirs")
    removed, added = difference(ours, theirs, source)
    gone = orphans(ours, removed)
    keep = checkpointed(ours.join(gone, "row_id", "left_anti"))
    cols = [c for c in graph.relations(ours) if c in theirs.columns]
    ids = subgraph(theirs, added)
    incoming = checkpointed(theirs.withColumn("row_id", F.col("row_id").cast("long")).join(ids, "row_id", "left_semi"))
    used = graph.wide_edges(incoming, [c[len(graph.PREFIX) :] for c in cols]).select(F.col("o").alias("row_id")).distinct()
    concept_rows = checkpointed(graph.of_type(theirs, CONCEPT).withColumn("row_id", F.col("row_id").cast("long")).join(used, "row_id", "left_semi"))
    known_concepts = graph.of_type(keep, CONCEPT).groupBy("pid").agg(F.min(F.col("row_id").cast("long")).alias("new_id"))
    known_others = keep.filter(~F.col("otype").isin(SAMPLE, CONCEPT)).groupBy("otype", "pid").agg(F.min(F.col("row_id").cast("long")).alias("new_id"))
    at = next_id(ours)
    # entities that are here already (the same type and pid) keep our row
    entity = incoming.select(F.col("row_id").alias("old_id"), "otype", "pid")
    there = entity.join(known_others, ["otype", "pid"]).select("old_id", "new_id")
    to_mint = entity.join(there, "old_id", "left_anti").select("otype", "pid").distinct()
    minted = checkpointed(mint(to_mint, at, "otype", "pid", name="new_id"))
    at += minted.count()
    fresh = concept_rows.select("pid").distinct().join(known_concepts, "pid", "left_anti")
    new_concepts = checkpointed(mint(fresh, at, "pid", name="new_id"))
    concept_ids = known_concepts.unionByName(new_concepts.select("pid", "new_id"))
    mapping = checkpointed(there.unionByName(entity.join(minted, ["otype", "pid"]).select("old_id", "new_id")).unionByName(concept_rows.select(F.col("row_id").alias("old_id"), "pid").join(concept_ids, "pid").select("old_id", "new_id")))
    wanted = incoming.join(there.select(F.col("old_id").alias("row_id")), "row_id", "left_anti")
    moved = remap_columns(wanted, mapping, cols)
    moved = moved.join(mapping.select(F.col("old_id").alias("row_id"), F.col("new_id").alias("_id")), "row_id").withColumn("row_id", F.col("_id")).drop("_id").dropDuplicates(["row_id"])
    moved = moved.withColumn("n", F.lit(source))
    if points is not None:
        require_unique(points, "pid", "points")
        have = set(moved.columns)
        moved = moved.drop(*[c for c in ("latitude", "longitude") if c in have]).join(points, "pid", "left")
    rows = concept_rows.join(new_concepts, "pid").withColumn("row_id", F.col("new_id")).drop("new_id").dropDuplicates(["pid"])
    rows = rows.drop(*[c for c in rows.columns if c.startswith(graph.PREFIX)])
    out = checkpointed(keep.unionByName(conform(moved, ours)).unionByName(conform(rows, ours)))
    check_sync(out, theirs, source, removed)
    return out


def check_sync(out: DataFrame, theirs: DataFrame, source: str, removed: DataFrame) -> None:
    """The rules that the result of a synchronisation must keep."""
    require_unique(out, "row_id", "result")
    require_unique(graph.of_type(out, SAMPLE), "pid", "result")
    require_none(graph.of_type(out, SAMPLE).join(removed, "pid", "left_semi").select("pid"), "stale samples")
    a = graph.of_type(out, SAMPLE).filter(F.col("n").eqNullSafe(F.lit(source))).count()
    b = graph.of_type(theirs, SAMPLE).count()
    if a != b:
        raise SyncError(f"{source} has {a} samples, the other side {b}")
    require_none(dangling(out), "references to rows that are not there")


def dangling(wide: DataFrame) -> DataFrame:
    """(s, p, o): references, in any column, to ids that no row has."""
    return graph.wide_edges(wide).join(wide.select(F.col("row_id").cast("long").alias("o")), "o", "left_anti")
