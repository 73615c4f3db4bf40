"""What the search steps must keep to so that they grow with their input only."""

import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corelode.functions import text as tx
from corelode.operators import search as se

FRAGS = [("a", "f", "red red pot"), ("a", "g", "pot"), ("b", "f", "blue"), ("b", "f", "blue pot"), (None, "f", "red"), (None, "f", "pot red"), ("c", "f", " - "), ("d", "f", "Çatal red")]


@pytest.fixture(scope="module")
def frags(spark):
    return spark.createDataFrame(FRAGS, "pid string, field string, text string")


def test_postings_of_single_fragments_are_not_shuffled(spark):
    one = spark.createDataFrame([("a", "f", "red pot"), ("b", "f", "red")], "pid string, field string, text string")
    got = se.postings(one)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.token, r.pid, r.tf, r.doc_len) for r in got.collect()} == {("red", "a", 1, 2), ("pot", "a", 1, 2), ("red", "b", 1, 1)}


def test_documents_of_several_fragments(frags):
    """Fragments of a document are counted together, those without an id as well."""
    words: dict = {}
    for pid, field, text in FRAGS:
        words.setdefault((pid, field), Counter()).update(tx.tokenise(text))
    want = {(t, p, f, n, sum(c.values())) for (p, f), c in words.items() for t, n in c.items()}
    rows = se.postings(frags)
    assert {(r.token, r.pid, r.field, r.tf, r.doc_len) for r in rows.collect()} == want and rows.count() == len(want)
    df = Counter(t for t, *_ in want)
    assert {r.token: r.df for r in se.frequencies(frags).collect()} == df
    assert {(r.pid, r.field, r.doc_len) for r in se.documents(frags).collect()} == {(p, f, sum(c.values())) for (p, f), c in words.items() if c}
    s = se.build_stats(se.documents(frags), se.frequencies(frags)).first()
    assert tuple(s) == (5, 3, len(df), len(want))


def test_layout_counts_tokens_and_cuts_large_ones(spark, monkeypatch):
    monkeypatch.setattr(se, "PART_POSTINGS", 40)
    frags = spark.createDataFrame([(f"p{k}", "f", f"all w{k % 7} only{k}") for k in range(200)], "pid string, field string, text string")
    df = se.frequencies(frags).cache()
    out = se.laid_out(se.hashed_postings(frags), df, 4)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(shard") == 1
    rows = out.collect()
    assert len(rows) == 600 and {(r.token, r.df) for r in rows} == {(r.token, r.df) for r in df.collect()}
    assert {r.part for r in rows if r.token == "all"} == set(range(5)) and {r.part for r in rows if r.token != "all"} == {-1}
    assert all(r.hash == tx.fnv1a32(r.token) and r.shard == r.hash % 4 for r in rows)


def _files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_shards_that_outgrow_the_cap_are_sliced(spark, tmp_path, monkeypatch):
    """Many rare tokens in few shards: moving single tokens out could never make them fit."""
    rounds = []
    write = se._write_shards
    monkeypatch.setattr(se, "_write_shards", lambda *a: (rounds.append(1), write(*a)))
    rows = [(f"t{k % 15000}", f"p{k}", "sample.label", 1, 4) for k in range(30000)]
    stored = se.with_df(spark.createDataFrame(rows, "token string, pid string, field string, tf int, doc_len int")).cache()
    path = str(tmp_path / "index")
    m = se.write_index(stored, path, cap_bytes=16000, shards=2)
    assert not m.too_large and len(rounds) <= 3 and max(map(os.path.getsize, _files(path))) <= 16000
    disk, again = se.open_index(spark, path)
    assert again == m and set(m.slices) == {0, 1}
    assert disk.count() == 30000 and disk.select(stored.columns).exceptAll(stored).count() == 0
    stats = se.field_stats(stored)
    p = se.plan("t77", m)
    assert p.expected_bytes == m.sizes[p.files[0]] and 0 < p.expected_bytes <= 16000
    hit = se.answer("t77", disk, stats, m, top=None)
    assert {r.pid: r.score for r in hit.collect()} == pytest.approx({r.pid: r.score for r in se.answer("t77", stored, stats, se.Manifest(), top=None).collect()})
    assert len({f for f in disk.filter((F.col("shard") == m.place("t77")[0]) & (F.col("slice") == m.place("t77")[1])).inputFiles()}) >= 1


def test_hashes_and_pieces_of_arrays(monkeypatch):
    words = ["", "a", "pottery", "Ça", None, "日本"]
    assert tx.fnv1a32_array(pa.array(words).slice(1)).to_pylist() == [tx.fnv1a32(w or "") for w in words[1:]]
    monkeypatch.setattr(tx, "PIECE_BYTES", 20)
    texts = ["red red pot", None, "blue", "x" * 50, ""] * 3
    assert tx._in_pieces(tx.token_array, pa.array(texts)).to_pylist() == [tx.tokenise(t) for t in texts]
    assert len(tx._in_pieces(tx.token_array, pa.array([], pa.string()))) == 0
