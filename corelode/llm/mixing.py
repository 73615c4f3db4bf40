"""Mixing sources to target weights by subset-sum budget fitting.

The budget of a source is its target weight times the total.  Documents are
counted by exact token length in each source, in tokens of the vocabulary that the
output is coded with.  A source first takes the same share of every length, rounded
down; what then remains of its budget is filled as exactly as the leftover lengths
allow by a bounded-knapsack dynamic programme over (length, count).  Which documents
of a length are taken is decided by a seeded hash, so the choice is uniform and
repeatable.

The lengths are written once beside the documents.  Only (source, length, hash)
triples are shuffled.  The choice comes back as one hash threshold per (source,
length), so the texts never move.  A threshold is found by counting hashes in
``2 ** BUCKET_BITS`` buckets and ranking inside the one bucket where the count is
reached, so that a length that very many documents have is sorted by no task.

By default the target weights are ``share ** temperature``, normalised, and the
total is the largest that no source falls short of.

Defined results: a null source is a source of its own; null and empty texts have
length zero, cost nothing and are kept; rows that repeat a ``doc_id`` and a length
in a source are one unit that costs their total and is taken or left as a whole;
rows with a null ``doc_id`` are told apart by their text; a source that is missing
from given weights, or whose weight is zero, gets no budget; a source with less
text than its budget is taken whole; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rans, shared

TEMPERATURE = 0.7
SEED = 17
MAX_BROADCAST_ROWS = 4_000_000
BUCKET_BITS = 16
ROOM = 1 << 16  # tokens of a budget that the dynamic programme fills


def measured(docs: DataFrame, vocabulary: str = rans.VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with ``_l``, the number of tokens of each text, written down."""
    return shared.written(rans.counted(docs, "_l", vocabulary, text), "mix-docs")


def knapsack(costs: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each cost to take so that their sum is the largest up to ``budget``.

    Bounded knapsack with value equal to cost: counts are split into powers of
    two and reachable sums are the bits of one integer.  Among equal sums,
    earlier pieces (larger costs first) are preferred to be left out.
    """
    take = np.zeros(len(costs), dtype=np.int64)
    mask = (1 << (budget + 1)) - 1
    reach, pieces, states = 1, [], []
    for i in np.argsort(-costs, kind="stable"):
        cost, left, size = int(costs[i]), int(min(counts[i], budget // max(int(costs[i]), 1))), 1
        while left > 0 and cost > 0:
            n = min(size, left)
            states.append(reach)
            pieces.append((int(i), n, n * cost))
            reach |= (reach << (n * cost)) & mask
            left -= n
            size *= 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    for (i, n, cost), before in zip(reversed(pieces), reversed(states)):
        if not before >> at & 1:
            take[i] += n
            at -= cost
    return take


def leave_out(costs: np.ndarray, counts: np.ndarray, excess: int) -> np.ndarray:
    """How many of each cost to leave out so that their sum is the least that reaches ``excess``."""
    upto = excess + int(costs.max())
    out = np.zeros(len(costs), dtype=np.int64)
    mask = (1 << (upto + 1)) - 1
    reach, pieces, states = 1, [], []
    for i in np.argsort(-costs, kind="stable"):
        cost, left, size = int(costs[i]), int(min(counts[i], upto // max(int(costs[i]), 1))), 1
        while left > 0 and cost > 0:
            n = min(size, left)
            states.append(reach)
            pieces.append((int(i), n, n * cost))
            reach |= (reach << (n * cost)) & mask
            left -= n
            size *= 2
        if reach >> excess & 1:
            break
    above = reach >> excess
    at = excess + (above & -above).bit_length() - 1
    for (i, n, cost), before in zip(reversed(pieces), reversed(states)):
        if not before >> at & 1:
            out[i] += n
            at -= cost
    return out


def fit_budget(costs: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts to take per cost: an even share of each, then the knapsack for the rest.

    The even share is lowered until the rest can absorb one longest document, so
    that the dynamic programme has lengths to choose from.
    """
    costs, counts = costs.astype(np.int64), counts.astype(np.int64)
    total = int((costs * counts).sum())
    if total <= budget:
        return counts.copy()
    if budget <= 0:
        return np.where(costs == 0, counts, 0)
    if total - budget <= ROOM:  # little is left out: choose that instead
        return counts - leave_out(costs, counts, total - budget)
    room = min(budget, max(ROOM, 2 * int(costs.max())))
    share = (budget - room) / total
    base = np.floor(counts * share).astype(np.int64)
    rest = budget - int((base * costs).sum())
    # more whole documents, longest remainder first, until about ``room`` is left
    part = counts * share - base
    order = np.lexsort((costs, -part))
    spent = np.cumsum(costs[order])
    more = order[: int(np.searchsorted(spent, rest - room, side="right"))] if rest > room else order[:0]
    base[more] += (base[more] < counts[more]).astype(np.int64)
    rest = budget - int((base * costs).sum())
    out = base + knapsack(costs, counts - base, rest)
    return np.where(costs == 0, counts, out)


def default_weights(units: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, weight): shares of the tokens to the power ``temperature``, normalised."""
    t = units.groupBy("source").agg(F.sum(F.col("length") * F.col("m")).alias("have")).filter("have > 0")
    every = Window.partitionBy()
    return t.select("source", (F.pow("have", F.lit(temperature)) / F.sum(F.pow("have", F.lit(temperature))).over(every)).alias("weight"), "have")


def _units(rows: DataFrame) -> DataFrame:
    return rows.filter("length > 0").groupBy("source", "length", "h").agg(F.count(F.lit(1)).alias("m"))


def plan(docs: DataFrame, weights: dict | None = None, total: int | None = None, seed: int = SEED, temperature: float = TEMPERATURE, text: str = "text", source: str = "source", doc_id: str = "doc_id"):
    """(units, thresholds, budgets) of the mix of measured documents; see :func:`mix`."""
    spark = docs.sparkSession
    rows = docs.select(F.col(source).cast("string").alias("source"), F.col("_l").alias("length"), _hash(doc_id, text, seed).alias("h"))
    units = shared.written(_units(rows), "mix-units")
    have = default_weights(units, temperature)  # one row per source
    if weights is not None:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double").filter("weight > 0")
        norm = given.select("source", (F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("weight"))
        joined = have.drop("weight").withColumnRenamed("source", "s").join(norm, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        have = joined.select("source", "weight", "have")
    if total is None:
        have = have.withColumn("all", F.min(F.floor(F.col("have") / F.col("weight"))).over(Window.partitionBy()))
    else:
        have = have.withColumn("all", F.lit(int(total)))
    budgets = shared.written(have.select("source", "weight", "have", F.least("have", F.round(F.col("all") * F.col("weight")).cast("long")).alias("budget")), "mix-budget")
    classes = units.groupBy("source", "length", "m").agg(F.count(F.lit(1)).alias("n"))
    with_budget = classes.join(F.broadcast(budgets.select(F.col("source").alias("s"), "budget")), F.col("source").eqNullSafe(F.col("s"))).drop("s")  # one row per source

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "m"]).reset_index(drop=True)
        pdf["take"] = fit_budget((pdf["length"] * pdf["m"]).to_numpy(), pdf["n"].to_numpy(), int(pdf["budget"].iloc[0]))
        return pdf[["source", "length", "m", "take"]]

    chosen = with_budget.groupBy("source").applyInPandas(choose, "source string, length long, m long, take long")
    chosen = shared.written(chosen.filter("take > 0"), "mix-chosen")
    limits = shared.written(thresholds(units, chosen), "mix-limits")
    return units, limits, budgets


def thresholds(units: DataFrame, chosen: DataFrame) -> DataFrame:
    """(source, length, m, h_max): the hash of the last unit taken of each (source, length, m)."""
    key = ["source", "length", "m"]
    bucket = F.shiftright("h", 64 - BUCKET_BITS).cast("int").alias("bucket")
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("bucket"))  # at most a row a bucket
    counts = units.groupBy(*key, bucket).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    c = chosen.select(F.col("source").alias("s"), F.col("length").alias("l"), F.col("m").alias("k"), "take")
    on = F.col("source").eqNullSafe(F.col("s")) & (F.col("length") == F.col("l")) & (F.col("m") == F.col("k"))
    edge = counts.join(c, on).filter("upto - n < take and take <= upto")
    edge = edge.select("s", "l", "k", F.col("bucket").alias("b"), (F.col("take") - F.col("upto") + F.col("n")).alias("rank"))
    inside = units.select(*key, "h", bucket).join(edge, on & (F.col("bucket") == F.col("b")))
    order = Window.partitionBy(*key).orderBy("h")
    return inside.withColumn("r", F.row_number().over(order)).filter("r = rank").select(*key, F.col("h").alias("h_max"))


def _hash(doc_id: str, text: str, seed: int) -> Column:
    return F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit(seed), F.lit(0), F.col(text))).otherwise(F.xxhash64(F.lit(seed), F.lit(1), F.col(doc_id).cast("string")))


def mix(docs: DataFrame, weights: dict | None = None, total: int | None = None, seed: int = SEED, temperature: float = TEMPERATURE, text: str = "text", source: str = "source", doc_id: str = "doc_id", vocabulary: str = rans.VOCABULARY, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The documents of the mix, with their own columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, source, doc_id = (f"c{names.index(c)}" for c in (text, source, doc_id))
    held = measured(inner, vocabulary, text)
    units, limits, _ = plan(held, weights, total, seed, temperature, text, source, doc_id)
    rows = held.withColumn("_s", F.col(source).cast("string")).withColumn("_h", _hash(doc_id, text, seed))
    # units of several rows are rare and named one by one
    many = units.filter("m > 1").select(F.col("source").alias("ms"), F.col("length").alias("ml"), F.col("h").alias("mh"), F.col("m").alias("mm"))
    if many.isEmpty():
        rows = rows.withColumn("_m", F.lit(1).cast("long"))
    else:
        rows = rows.join(many, F.col("_s").eqNullSafe(F.col("ms")) & (F.col("_l") == F.col("ml")) & (F.col("_h") == F.col("mh")), "left").withColumn("_m", F.coalesce("mm", F.lit(1).cast("long")))
    cut = limits.select(F.col("source").alias("ts"), F.col("length").alias("tl"), F.col("m").alias("tm"), "h_max")
    if limits.count() <= max_broadcast_rows:
        cut = F.broadcast(cut)
    on = F.col("_s").eqNullSafe(F.col("ts")) & (F.col("_l") == F.col("tl")) & (F.col("_m") == F.col("tm"))
    kept = rows.join(cut, on, "left").filter((F.col("_l") == 0) | (F.col("_h") <= F.col("h_max")))
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
