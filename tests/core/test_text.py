from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corelode.functions import text as tx


@pytest.mark.parametrize("text,want", [("Çatalhöyük", ["catalhoyuk"]), ("Iron-Age", ["iron", "age"]), ("ﬁne №5", ["fine", "no5"]), ("", []), (None, []), ("a" * 65 + " b", ["b"]), ("x" * 64, ["x" * 64]), ("Straße", ["straße"]), ("日本 語", ["日本", "語"])])
def test_tokenise(text, want):
    assert tx.tokenise(text) == want


@pytest.mark.parametrize("word,want", [("pottery", 3121265474), ("cyprus", 1194896787), ("a", 3826002220), ("", tx.FNV_OFFSET)])
def test_fnv(spark, word, want):
    assert tx.fnv1a32(word) == want
    assert spark.createDataFrame([(word,)], "w string").select(tx.fnv1a32_col(F.col("w"))).first()[0] == want


def test_collision_pair():
    assert tx.fnv1a32("tywtopf1ri") == tx.fnv1a32("32jnqttihd")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aZ9 -_\n.éÉçßœŒﬁ№İıΣσςáΆ日本ー\u0301\u0308\u200b²½ﾊﾟ𝔸א\u05b0ก็"), max_size=30), st.text(alphabet="ab ", min_size=60, max_size=140)), max_size=6))
def test_whole_arrays_give_the_tokens_of_single_texts(texts):
    assert tx.token_array(pa.array(texts, pa.string())).to_pylist() == [tx.tokenise(t) for t in texts]
    counts = tx.token_counts_array(pa.array(texts, pa.string())).to_pylist()
    assert [{x["token"]: x["n"] for x in c} for c in counts] == [dict(Counter(tx.tokenise(t))) for t in texts]


def test_tokens_of_all_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text", tx.tokens(F.col("text")).alias("w"))
    assert all(r.w == tx.tokenise(r.text) for r in d.collect())


def test_patterns_take_wildcards_literally(spark):
    df = spark.createDataFrame([("100% sure", "x"), ("100 sure", "_test"), ("a\\b", None)], "a string, b string")
    hits = lambda *t: [r.a for r in df.filter(tx.text_where(t, [F.col("a"), F.col("b")])).collect()]
    assert hits("100%") == ["100% sure"] and hits("_test") == ["100 sure"] and hits("\\") == ["a\\b"]
    assert hits("SURE", "x") == ["100% sure"] and len(hits()) == 3
    got = df.select(tx.text_score(["sure", "100"], [(F.col("a"), 3), (F.col("b"), 1)]).alias("s")).collect()
    assert [r.s for r in got] == [6.0, 6.0, 0.0]


@pytest.mark.parametrize("term,want", [("ARK:/28722/x", "ark:28722/x"), ("https://n2t.net/ark:/1/2", "ark:1/2"), ("http://doi.org/10.5/A", "10.5/a"), ("IGSN:ABC", "igsn:abc"), (" x ", "x")])
def test_canonical_pid(term, want):
    assert tx.canonical_pid(term) == want


@pytest.mark.parametrize("term,want", [("pid:x", True), ("ark:1", True), ("10.5281/z", True), ("https://hdl.handle.net/1", True), ("https://other.org/1", False), ("pottery", False)])
def test_looks_like_pid(term, want):
    assert tx.looks_like_pid(term) is want


def test_pid_where(spark):
    df = spark.createDataFrame([("ark:/28722/k2",), ("ark:28722/k2",), ("ARK:/28722/k9",), ("igsn:ABC1",)], "pid string")
    find = lambda t: [r.pid for r in df.filter(tx.pid_where(t, F.col("pid"))).collect()]
    assert find("ark:/28722/k2") == ["ark:/28722/k2", "ark:28722/k2"]
    assert find("pid:bc1") == ["igsn:ABC1"] and find("https://n2t.net/ark:28722/k9") == ["ARK:/28722/k9"]


def test_labels_and_places(spark):
    df = spark.createDataFrame([("http://v/a/Rock#", None, ["A", "", None, "B"]), ("http://v/b/", " ", None), ("u", "Label", [])], "uri string, label string, place array<string>")
    got = df.select(tx.label_or_tail(F.col("label"), F.col("uri")).alias("l"), tx.place_text(F.col("place")).alias("p")).collect()
    assert [(r.l, r.p) for r in got] == [("Rock", "A › B"), ("b", ""), ("Label", "")]


def test_csv_fields(spark):
    cases = ["=1+1", "-5", "-a", "+1e5", "@x", 'say "hi"', "a,b", "cr\rhere", "", None, "plain"]
    want = ["'=1+1", "-5", "'-a", "+1e5", "'@x", '"say ""hi"""', '"a,b"', '"cr\rhere"', "", "", "plain"]
    got = spark.createDataFrame([(c,) for c in cases], "c string").select(tx.csv_field(F.col("c")).alias("c")).collect()
    assert [r.c for r in got] == want


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_tokens_are_stable_under_tokenising(text):
    once = tx.tokenise(text)
    assert [t for w in once for t in tx.tokenise(w)] == once
