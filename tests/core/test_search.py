"""The index on ten documents counted by hand, planning, and the agreement of both search paths."""

import math
import os

import pytest
from pyspark.sql import functions as F

from corelode.functions import text as tx
from corelode.operators import search as se
from corelode.operators import views

SAMPLES = [("p1", "Pottery sherd", "red pottery from a trench", ["Çatalhöyük"]), ("p2", "Iron-Age pottery", None, ["Cyprus", ""]), ("p3", "Basalt", "dark", None), ("p4", "", "  ", [])]
CONCEPTS = [(1, "http://v/rock", None), (2, "http://v/ceramic", "own label"), (3, "http://v/kw", "Keyword pottery")]
VOCAB = [("http://v/rock", "Rock", "en"), ("http://v/rock", "Roche", "fr"), ("http://v/ceramic", "Ceramic", None)]
LINKS = [("p1", 2), ("p3", 1), ("p4", 3), ("p2", 9)]


@pytest.fixture(scope="module")
def frags(spark):
    s = spark.createDataFrame(SAMPLES, "pid string, label string, description string, place_name array<string>")
    return se.fragments(s, spark.createDataFrame(LINKS, "pid string, concept long"), spark.createDataFrame(CONCEPTS, "row_id long, pid string, label string"), spark.createDataFrame(VOCAB, "uri string, pref_label string, lang string")).cache()


@pytest.fixture(scope="module")
def stored(frags):
    return se.with_df(se.postings(frags)).cache()


def test_fragments(frags):
    got = sorted((r.pid, r.field, r.text) for r in frags.collect() if r.field == "concept.label")
    assert got == [("p1", "concept.label", "Ceramic"), ("p3", "concept.label", "Rock"), ("p4", "concept.label", "Keyword pottery")]
    assert frags.filter("pid = 'p4' and field <> 'concept.label'").count() == 0


def test_postings_and_df(stored):
    df = {r.token: r.df for r in stored.select("token", "df").distinct().collect()}
    assert df["pottery"] == 4 and df["catalhoyuk"] == 1 and df["iron"] == df["age"] == 1
    r = stored.filter("pid = 'p1' and field = 'sample.description' and token = 'pottery'").first()
    assert (r.tf, r.doc_len) == (1, 5)


def test_bm25_by_hand(spark, stored):
    stats = se.field_stats(stored)
    n = stored.select("pid", "field").distinct().count()
    rows = stored.filter("token = 'pottery'").collect()
    avg = {r.field: r.avg_len for r in stats.collect()}
    want: dict = {}
    for r in rows:
        idf = math.log((n - 4 + 0.5) / (4 + 0.5) + 1)
        want[r.pid] = want.get(r.pid, 0) + se.WEIGHTS[r.field] * idf * r.tf * 2.2 / (r.tf + 1.2 * (0.25 + 0.75 * r.doc_len / avg[r.field]))
    got = {r.pid: r.score for r in se.answer("pottery", stored, stats, se.Manifest()).collect()}
    assert got == pytest.approx(want)
    both = se.answer("the POTTERY cyprus", stored, stats, se.Manifest()).collect()
    assert [r.pid for r in both] == ["p2"]
    assert se.answer("pottery nothing", stored, stats, se.Manifest()).count() == 0
    assert se.answer("the of", stored, stats, se.Manifest()).count() == 0


def _files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_index_on_disk_keeps_to_its_cap(spark, tmp_path):
    """Heavy tokens leave their shards until every file fits; nothing is lost or doubled; searches read the same."""
    rows = [(f"w{k % 7}" if k % 3 else f"rare{k}", f"p{k // 4}", "sample.label", 1, 4, 1) for k in range(6000)]
    stored = se.with_df(spark.createDataFrame(rows, "token string, pid string, field string, tf int, doc_len int, df long").drop("df").dropDuplicates(["token", "pid", "field"])).cache()
    path = str(tmp_path / "index")
    m = se.write_index(stored, path, cap_bytes=9000, shards=4)
    assert not m.too_large and m.hot and max(map(os.path.getsize, _files(path))) <= 9000
    disk, again = se.open_index(spark, path)
    assert again == m and disk.count() == stored.count()
    assert disk.select("token", "pid", "field").exceptAll(stored.select("token", "pid", "field")).count() == 0
    for t, (key, parts, size, fetchable) in m.hot.items():
        mine = [f for f in _files(f"{path}/hot/key={key}")]
        assert parts >= 2 and len(mine) <= parts and sum(map(os.path.getsize, mine)) == size and fetchable == (size <= 9000)
        assert m.postings[t] == stored.filter(F.col("token") == t).count() and disk.filter((F.col("token") == t) & F.col("key").isNull()).count() == 0
    stats = se.field_stats(stored)
    for q in ("rare3", "w1 rare27", next(iter(m.hot))):
        known = se.Manifest(4, {t: (k, p, b, True) for t, (k, p, b, _) in m.hot.items()})
        want = {r.pid: r.score for r in se.answer(q, stored, stats, se.Manifest(4), top=None).collect()}
        assert {r.pid: r.score for r in se.answer(q, disk, stats, known, top=None).collect()} == pytest.approx(want)


def test_a_cap_that_cannot_be_kept_is_told(spark, stored, tmp_path, monkeypatch):
    monkeypatch.setattr(se, "ATTEMPTS", 1)
    m = se.write_index(stored, str(tmp_path / "index"), cap_bytes=1, shards=2)
    disk, again = se.open_index(spark, str(tmp_path / "index"))
    assert m.too_large and again == m and disk.count() == stored.count() and all(p >= 2 for _, p, _, _ in m.hot.values())


def test_keys_of_equal_hashes_differ():
    used = set()
    assert [se.hot_key(t, used) for t in ("tywtopf1ri", "32jnqttihd", "a")] == ["a7c9bf62", "a7c9bf62-1", f"{3826002220:08x}"]


def test_topk_lists(stored):
    top = se.hot_topk(stored, se.field_stats(stored), se.hot_tokens(stored, 2), top=2)
    rows = sorted((r["rank"], r.pid, r.static_score) for r in top.collect())
    assert [r[0] for r in rows] == [1, 2] and rows[0][2] >= rows[1][2]
    m = se.Manifest(hot={"pottery": ("k", 2, 10, False)})
    assert [r.pid for r in se.answer("pottery", stored, se.field_stats(stored), m, top).collect()] == [r[1] for r in rows]


def test_plans():
    m = se.Manifest(256, {"common": ("c", 3, 9_000_000, False), "warm": ("w", 2, 100, True)}, {f"shard_{k:03d}.parquet": 7 for k in range(256)})
    assert se.plan(" - ", m).mode == "empty" and se.plan("the OF", m).mode == "allStopwords"
    p = se.plan("common", m)
    assert (p.mode, p.tokens) == ("topk", ("common",))
    p = se.plan("the pottery common pottery warm", m)
    assert (p.mode, p.tokens, p.ignored, p.expected_bytes) == ("normal", ("pottery", "warm"), ("common",), 107)
    assert p.files == (f"shard_{3121265474 % 256:03d}.parquet", "hot/w_p0.parquet", "hot/w_p1.parquet")


def test_router():
    assert se.use_index(["pottery"]) and not se.use_index(["ark:1"]) and not se.use_index(["a"]) and not se.use_index(["pottery"], enabled=False)


def test_scan_path_and_result_shapes(spark):
    s = spark.createDataFrame([(*r, float(k)) for k, r in enumerate(SAMPLES)], "pid string, label string, description string, place_name array<string>, latitude double")
    got = {r.pid: r.relevance_score for r in se.scan_answer(s, ["pottery"]).collect()}
    assert got == {"p1": 4.0, "p2": 3.0}
    assert [r.pid for r in se.scan_answer(s, ["pid:P3"]).collect()] == ["p3"]
    scored = spark.createDataFrame([("p1", 1.0), ("p2", 1.0), ("gone", 5.0)], "pid string, score double")
    assert [r.pid for r in views.search_area(scored, s, F.col("latitude") < 1, 50).collect()] == ["p1"]
    assert [r.pid for r in views.search_world(scored, s, 2).collect()] == ["gone", "p1"]


def test_clamps_are_counted(spark):
    long = spark.createDataFrame([("p", "sample.label", "w " * 70000)], "pid string, field string, text string")
    r = se.clamped(se.postings(long)).first()
    assert (r.tf_clamped, r.len_clamped, r.max_tf) == (1, 1, se.CLAMP)
