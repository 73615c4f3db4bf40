from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corelode.llm import mixing as M
from corelode.llm import rans


def best_sum(costs, counts, budget):
    reach = {0}
    for c, n in zip(costs, counts):
        reach = {r + k * c for r in reach for k in range(n + 1) if r + k * c <= budget}
    return max(reach)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 5)), min_size=1, max_size=5, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_knapsack_is_the_best_subset_sum(items, budget):
    costs, counts = (np.array(x) for x in zip(*items))
    take = M.knapsack(costs, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    assert int((take * costs).sum()) == best_sum(costs, counts, budget)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 5)), min_size=1, max_size=5, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_small_budgets_are_fitted_best(items, budget):
    costs, counts = (np.array(x) for x in zip(*items))
    take = M.fit_budget(costs, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    assert int((take * costs).sum()) == best_sum(costs, counts, budget)


def test_fit_budget_is_exact_on_many_documents():
    rng = np.random.default_rng(1)
    costs = np.unique(rng.integers(50, 3000, 500))
    counts = rng.integers(1, 400, len(costs))
    total = int((costs * counts).sum())
    for budget in (total // 3, total // 2 + 1, total - 777):
        take = M.fit_budget(costs, counts, budget)
        assert int((take * costs).sum()) == budget and (take <= counts).all()


def brute_mix(rows, hashes, budgets):
    """The lowest hashes of each length, as many as the plan takes."""
    kept = []
    for source in budgets:
        mine = [(n, h, k) for k, (s, n, h) in enumerate(zip(rows["s"], rows["n"], hashes)) if s == source and n > 0]
        by = Counter(n for n, _, _ in mine)
        costs = np.array(sorted(by))
        take = M.fit_budget(costs, np.array([by[c] for c in costs]), budgets[source])
        for c, t in zip(costs, take):
            kept += [k for _, _, k in sorted(x for x in mine if x[0] == c)[:t]]
    return kept


def test_against_brute_force(sf):
    docs = sf("documents")
    held = M.measured(docs)
    _, _, budgets = M.plan(held)
    b = {r.source: r.budget for r in budgets.collect()}
    t = held.select("doc_id", F.col("source").alias("s"), F.col("_l").alias("n"), M._hash("doc_id", "text", M.SEED).alias("h"), "text").collect()
    enc = rans.encoder(rans.VOCABULARY)
    assert all(r.n == len(enc.encode_ordinary(r.text)) for r in t)
    want = {t[k].doc_id for k in brute_mix({"s": [r.s for r in t], "n": [r.n for r in t]}, [r.h for r in t], b)} | {r.doc_id for r in t if r.n == 0}
    got = M.mix(docs)
    assert {r.doc_id for r in got.collect()} == want
    # in tokens that the output codes, no choice of documents comes closer to the budgets
    spent = {r.source: r.n for r in M.measured(got).groupBy("source").agg(F.sum("_l").alias("n")).collect()}
    for source, budget in b.items():
        mine = Counter(r.n for r in t if r.s == source and r.n)
        assert spent[source] == best_sum(list(mine), list(mine.values()), budget)


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_thresholds_against_sorting(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BUCKET_BITS", bits)
    rng = np.random.default_rng(bits)
    rows = [(s, 7, 1, int(h)) for s in ("a", None) for h in rng.integers(-(2**63), 2**63 - 1, 300)]
    take = {"a": 299, None: 17}
    units = spark.createDataFrame(rows, "source string, length long, m long, h long")
    got = {r.source: r.h_max for r in M.thresholds(units, spark.createDataFrame([(s, 7, 1, n) for s, n in take.items()], "source string, length long, m long, take long")).collect()}
    assert got == {s: sorted(h for x, _, _, h in rows if x == s)[n - 1] for s, n in take.items()}


@pytest.mark.parametrize("limit", [M.MAX_BROADCAST_ROWS, 0])
def test_weights_and_total(spark, limit):
    rows = [(k, ("w " * (k % 7 + 1)).strip(), "ab"[k % 2]) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(docs, weights={"a": 3, "b": 1}, total=200, max_broadcast_rows=limit)
    assert {r.source: r.n for r in M.measured(got).groupBy("source").agg(F.sum("_l").alias("n")).collect()} == {"a": 150, "b": 50}
    assert {r.source for r in M.mix(docs, weights={"a": 1}, total=10).collect()} == {"a"}


def test_edge_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (3, "", "x"), (4, "  ", None), (None, "c d", None), (5, "e " * 50000, "y"), (6, "f g", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("h", F.lit(1))
    got = M.mix(docs, total=100)
    assert got.columns == docs.columns
    ids = sorted((r.doc_id or 0) for r in got.collect())
    assert {2, 3} <= set(ids) and ids.count(1) in (0, 2) and 5 not in ids
    assert M.mix(docs.limit(0)).count() == 0
    assert M.mix(docs, weights={"x": 1, "y": 1, "none": 1}, total=10**9).filter("source is not null").count() == 6
