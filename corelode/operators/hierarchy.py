"""Concept trees: closure, membership, bits, masks and the complete index.

The vocabulary is small next to the samples, so its closure is taken first and the
samples meet it in one equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import fingerprint as fp
from ..lineage import local, written

MAX_DEPTH = 64
MAX_BITS = 63
MAX_LOCAL_NODES = 100_000
SCHEMA_VERSION = 1


def parents_of(vocabulary: DataFrame, uri: str = "uri", broader: str = "broader") -> DataFrame:
    """(uri, parent_uri): the tree; of several parents the first in order is taken."""
    return vocabulary.groupBy(F.col(uri).alias("uri")).agg(F.min(broader).alias("parent_uri"))


def closure(tree: DataFrame, max_local: int = MAX_LOCAL_NODES) -> DataFrame:
    """(uri, ancestor_uri, distance): every node with all its ancestors, itself at 0.

    Vocabularies are small: up to ``max_local`` nodes are walked in place, which costs
    one small job; a larger tree is closed by pointer doubling with the same rows.
    The distance is bounded, so a cycle ends; :func:`check_tree` tells cycles.
    """
    spark = tree.sparkSession
    rows = tree.select("uri", "parent_uri").limit(max_local + 1).collect()  # bounded
    if len(rows) <= max_local:
        up = {r.uri: r.parent_uri for r in rows}
        out = []
        for uri in up:
            at, n, seen = uri, 0, set()
            while at is not None and at not in seen and n <= MAX_DEPTH:
                out.append((uri, at, n))
                seen.add(at)
                at, n = up.get(at), n + 1
        of = to_arrow_type(tree.schema["uri"].dataType)
        return local(spark, out, uri=of, ancestor_uri=of, distance=pa.int32())
    return closure_by_doubling(tree)


def closure_by_doubling(tree: DataFrame) -> DataFrame:
    """The same for trees of any size, in a number of rounds that is the logarithm of the depth.

    After a round every node has its ancestors below twice the distance, and a pointer
    to the one at just that distance.
    """
    step = written(tree.filter("parent_uri is not null").select("uri", F.col("parent_uri").alias("to")), "tree-step")
    known = written(tree.select("uri", F.col("uri").alias("ancestor_uri"), F.lit(0).alias("distance")), "tree-known")
    reach = 1
    while reach <= MAX_DEPTH and not step.isEmpty():
        far = known.select(F.col("uri").alias("to"), "ancestor_uri", (F.col("distance") + reach).alias("distance"))
        known = written(known.unionByName(step.join(far, "to").select("uri", "ancestor_uri", "distance").filter(F.col("distance") <= MAX_DEPTH)), "tree-known")
        step = written(step.join(step.select(F.col("uri").alias("to"), F.col("to").alias("next")), "to").select("uri", F.col("next").alias("to")), "tree-step")
        reach *= 2
    return known.groupBy("uri", "ancestor_uri").agg(F.min("distance").alias("distance"))


def depths(tree: DataFrame) -> DataFrame:
    """(uri, parent_uri, depth): steps from the root."""
    far = closure(tree).groupBy("uri").agg((F.count(F.lit(1)) - 1).cast("int").alias("depth"))
    return tree.join(far, "uri").select("uri", "parent_uri", "depth")


def check_tree(tree: DataFrame) -> DataFrame:
    """Nodes that are their own ancestor: rows here mean a cycle."""
    spark = tree.sparkSession
    tree.select("uri", "parent_uri").createOrReplaceTempView("corelode_tree")
    return spark.sql(f"""
        WITH RECURSIVE up(uri, at, n) AS (
            SELECT uri, parent_uri, 1 FROM corelode_tree WHERE parent_uri IS NOT NULL
            UNION ALL
            SELECT up.uri, t.parent_uri, n + 1 FROM up JOIN corelode_tree t ON t.uri = up.at
            WHERE t.parent_uri IS NOT NULL AND up.at <> up.uri AND n < {MAX_DEPTH}
        )
        SELECT DISTINCT uri FROM up WHERE at = uri
    """)


def assign(closed: DataFrame, roots: DataFrame) -> DataFrame:
    """(uri, facet_type): the dimension whose root a node reaches."""
    r = F.broadcast(roots.select(F.col("root_uri").alias("ancestor_uri"), "facet_type"))  # one row per dimension
    return closed.join(r, "ancestor_uri").select("uri", "facet_type").distinct()


def unreachable(tree: DataFrame, assigned: DataFrame) -> DataFrame:
    """Nodes that reach no root: they belong to no dimension and are reported."""
    return tree.select("uri").join(assigned.select("uri"), "uri", "left_anti")


def membership(asserted: DataFrame, closed: DataFrame, assigned: DataFrame, roots: DataFrame, depth: DataFrame, key: str = "pid") -> DataFrame:
    """(pid, facet_type, concept_uri, depth): samples with all ancestors of their concepts.

    Of the asserted concepts (pid, facet_type, uri) the root of the dimension does not
    count; ancestors count in the dimension of the assertion only.  A concept brings its
    ancestors as one array, so what is shuffled is one row an assertion; the rows
    come out partitioned by sample, as later steps want them.
    """
    root = roots.select("facet_type", F.col("root_uri").alias("uri"))
    same = assigned.select(F.col("uri").alias("ancestor_uri"), "facet_type")
    node = F.struct("facet_type", F.col("ancestor_uri").alias("concept_uri"), "depth")
    wide = closed.select("uri", "ancestor_uri").join(same, "ancestor_uri").join(depth.select(F.col("uri").alias("ancestor_uri"), "depth"), "ancestor_uri")
    above = wide.groupBy("uri", "facet_type").agg(F.array_sort(F.collect_list(node)).alias("up")).join(root, ["uri", "facet_type"], "left_anti")
    per = asserted.select(key, "facet_type", "uri").join(above, ["uri", "facet_type"]).groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("up"))).alias("up"))
    return per.select(key, F.explode("up").alias("z")).select(key, "z.facet_type", "z.concept_uri", "z.depth")


def tree_summaries(member: DataFrame, tree: DataFrame, key: str = "pid") -> DataFrame:
    """(facet_type, concept_uri, parent_uri, depth, count): samples of each node.

    Membership rows are distinct, so counting rows counts samples.
    """
    n = member.groupBy("facet_type", "concept_uri").agg(F.min("depth").alias("depth"), F.count(F.lit(1)).alias("count"))
    t = tree.select(F.col("uri").alias("concept_uri"), "parent_uri")
    return n.join(t, "concept_uri", "left").select("facet_type", "concept_uri", "parent_uri", "depth", "count")


def node_bits(summaries: DataFrame) -> DataFrame:
    """(facet_type, concept_uri, bit_index): dense from 0 by URI in each dimension."""
    w = Window.partitionBy("facet_type").orderBy("concept_uri")
    out = summaries.select("facet_type", "concept_uri").distinct()
    return out.withColumn("bit_index", (F.row_number().over(w) - 1).cast("int"))


def check_bits(bits: DataFrame) -> None:
    """A dimension of more than 63 nodes does not fit a long."""
    wide = bits.groupBy("facet_type").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MAX_BITS).collect()  # one row per dimension
    if wide:
        raise ValueError("too many nodes for a bit mask: " + ", ".join(f"{r.facet_type} has {r.n}" for r in wide))


def masks(member: DataFrame, bits: DataFrame, dims: Sequence[str], key: str = "pid") -> DataFrame:
    """(pid, one mask per dimension): the OR of the bits of a sample's nodes."""
    b = F.broadcast(bits.select("facet_type", "concept_uri", "bit_index"))  # at most 63 rows a dimension
    rows = member.join(b, ["facet_type", "concept_uri"])
    bit = F.expr("shiftleft(1L, bit_index)")
    return rows.groupBy(key).agg(*[F.coalesce(F.bit_or(F.when(F.col("facet_type") == d, bit)), F.lit(0).cast("long")).alias(f"{d}_mask") for d in dims])


def index(samples: DataFrame, mask_table: DataFrame, dims: Sequence[str], key: str = "pid") -> DataFrame:
    """(pid, source, masks): every sample, with empty masks where it has no nodes."""
    out = samples.select(key, "source").join(mask_table, key, "left")
    zero = F.lit(0).cast("long")
    return out.select(key, "source", *[F.coalesce(f"{d}_mask", zero).alias(f"{d}_mask") for d in dims])


def index_meta(samples: DataFrame) -> DataFrame:
    """(source, count, total_rows): per source without blanks; the total has all rows."""
    total = samples.agg(F.count(F.lit(1)).alias("total_rows"))  # one row
    n = samples.filter(F.trim("source") != "").groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    return n.crossJoin(F.broadcast(total))


def build_ids(member: DataFrame, samples: DataFrame) -> DataFrame:
    """(membership_id, coverage_id, build_id) of a generation of artefacts."""
    m = fp.xor_id(member, ["pid", "facet_type", "concept_uri", "depth"]).select(F.col("build_id").alias("membership_id"))
    c = fp.full_id(samples, ["pid", "source"]).select(F.col("build_id").alias("coverage_id"))
    return m.crossJoin(c).withColumn("build_id", F.concat_ws(":", "membership_id", "coverage_id"))
