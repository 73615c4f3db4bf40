"""Filters, views, sources, sinks, vocabularies and the entry point."""

import os
import shutil
import subprocess
import sys
import threading
import time

import pytest
from pyspark.sql import functions as F

from corelode import lineage
from corelode.functions import arrays as ar
from corelode.functions import fingerprint as fp
from corelode.operators import filters as fl
from corelode.operators import hierarchy, quality, setops, views
from corelode.sources import sinks, tables
from corelode.sources import vocabulary as vo
from corelode.streaming.generation import Generation

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([("a", "A", "rock"), ("b", "B", "metal"), ("c", None, "rock"), ("d", "A", None)], "pid string, source string, material string")


def test_source_filter(rows):
    n = lambda chosen: rows.filter(fl.source_where(chosen, ["A", "B"], F.col("source"))).count()
    assert n([]) == 0 and n(["A"]) == 2 and n(["A", "B"]) == 4 and n(None) == 4


def test_minimal_selection():
    up = {"root": None, "rock": "root", "basalt": "rock", "metal": "root", "x": "y", "y": "x"}
    assert fl.minimal_selection({"rock", "basalt", "metal"}, up) == {"rock", "metal"}
    assert fl.minimal_selection({"root", "basalt"}, up) == {"root"} and fl.minimal_selection({"x"}, up) == {"x"}


def test_masks_refuse_unknown_nodes():
    bits = {("m", "a"): 0, ("m", "b"): 62}
    assert fl.node_masks({"m": frozenset({"a", "b"})}, bits) == {"m": 1 | 1 << 62}
    assert fl.node_masks({"m": frozenset({"zz"})}, bits) is None and fl.node_masks({"m": frozenset()}, bits) == {}


def test_signature_ignores_order():
    a = fl.FilterState(sources=frozenset({"A", "B"}), values={"m": frozenset({"x", "y"}), "k": frozenset({"z"})})
    b = fl.FilterState(sources=frozenset({"B", "A"}), values={"k": frozenset({"z"}), "m": frozenset({"y", "x"})})
    assert a.signature() == b.signature() != a.without("m").signature()


def test_samples_are_repeatable(spark):
    df = spark.range(10_000).withColumnRenamed("id", "pid")
    a = fl.hash_sample(df, "pid", 10)
    assert 800 < a.count() < 1200 and a.exceptAll(fl.hash_sample(df.repartition(5), "pid", 10)).count() == 0
    assert fl.bernoulli_sample(df, 0.1, 3).count() == fl.bernoulli_sample(df, 0.1, 3).count()
    assert fl.exists(df, F.col("pid") == 5) and not fl.exists(df, F.col("pid") < 0)


def test_bad_dates_are_no_times(spark):
    df = spark.createDataFrame([("2020-05-01",), ("May",), (None,)], "t string")
    assert df.filter(fl.in_time(F.col("t"), "2020-01-01", "2020-12-31")).count() == 1


def test_pages_cover_all_rows_once(spark):
    df = spark.range(250).select(F.format_string("p%04d", "id").alias("pid"))
    got = [r.pid for k in range(3) for r in views.page(df, k).collect()]
    assert got == sorted(got) and len(set(got)) == 250
    assert views.count_if_capped(df, 100, 100) == 250 and views.count_if_capped(df, 7, 100) == 7


def test_nulls_come_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in views.ordered(df, "v").collect()] == [1, 2, None] and [r.v for r in views.ordered(df, "-v").collect()] == [2, 1, None]


def test_detail_card_is_one_row(spark):
    s = spark.createDataFrame([("a", [1]), ("b", []), ("c", None)], "pid string, m array<long>")
    c = spark.createDataFrame([(1, "http://v/rock")], "row_id long, pid string")
    v = spark.createDataFrame([("http://v/rock", "Rock", "en"), ("http://v/rock", "Roche", "fr")], "uri string, pref_label string, lang string")
    assert views.detail(s, "pid", "a", c, ["m"], v).collect()[0].m_label == "Rock"
    assert [r.m_uri for r in views.detail(s, "pid", "b", c, ["m"], v).collect()] == [None]


def test_csv_file(spark, tmp_path):
    df = spark.createDataFrame([("b", "=x", ["P", "Q"]), ("a", 'q"', None), (None, "z", None)], "pid string, label string, place_name array<string>")
    out = str(tmp_path / "x.csv")
    assert sinks.write_csv(views.csv_rows(df, ("pid", "label", "place_name", "url")), out, ("pid", "label", "place_name", "url")) == 2
    assert open(out, newline="").read() == 'pid,label,place_name,url\r\na,"q""",,https://n2t.net/a\r\nb,\'=x,P › Q,https://n2t.net/b'


def test_arrays(spark):
    df = spark.createDataFrame([(1, [5, 6, 5]), (2, []), (3, None), (4, [9])], "k int, a array<long>")
    assert [r.f for r in df.select(ar.first(F.col("a")).alias("f")).collect()] == [5, None, None, 9]
    assert [r.n for r in df.select(ar.length(F.col("a")).alias("n")).collect()] == [3, 0, None, 1]
    m = spark.createDataFrame([(5, 50), (6, 60)], "old_id long, new_id long")
    assert {r.k: r.a for r in ar.remap(df, "k", "a", m).collect()} == {1: [50, 60, 50]}
    assert [(r.k, r.o, r.v) for r in ar.exploded(df, "a", "v", "o").collect()] == [(1, 1, 5), (1, 2, 6), (1, 3, 5), (4, 1, 9)]
    firsts = spark.createDataFrame([(1, 0, "root"), (1, 1, "x"), (2, 0, "root")], "g int, o int, v string").groupBy("g").agg(ar.first_by(F.col("v"), F.col("o"), F.col("v") != "root").alias("f"))
    assert {r.g: r.f for r in firsts.collect()} == {1: "x", 2: None}


def test_fingerprints(spark):
    a = spark.createDataFrame([("x", None), ("y", "")], "k string, v string")
    b = spark.createDataFrame([("y", ""), ("x", None)], "k string, v string")
    c = spark.createDataFrame([("x", ""), ("y", None)], "k string, v string")
    get = lambda d, f=fp.full_id: f(d, ["k", "v"]).first()[0]
    assert get(a) == get(b) != get(c) and get(a) != get(a.union(a)) and get(a, fp.xor_id) == get(b, fp.xor_id)
    assert get(a.limit(0))


def test_set_operations_count_both_sides(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "v int"), spark.createDataFrame([(2,), (3,)], "v int")
    assert sorted(tuple(r) for r in setops.symmetric_difference(a, b).collect()) == [(1, "left"), (3, "right")]
    assert setops.union_distinct(a, b).count() == 3 and quality.duplicates(a, "v").count() == 1
    x, y = spark.createDataFrame([(1, None), (2, "a")], "k int, v string"), spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "k int, v string")
    assert sorted(r.k for r in setops.compare(x, y, "k", "v").collect()) == [2, 3]


def test_readers(spark, tmp_path):
    for k in range(3):
        spark.range(k, k + 2).coalesce(1).write.parquet(str(tmp_path / f"part_{k}.parquet"))
    assert tables.parquet(spark, str(tmp_path / "part_*.parquet")).count() == 6
    df = tables.parquet(spark, str(tmp_path / "part_0.parquet"), str(tmp_path / "part_1.parquet"))
    assert df.count() == 4 and tables.describe(df) == [("id", "bigint")] and tables.schema_matches(df, [("id", "bigint")])
    assert tables.has_column(df, "id") and tables.first_existing(df, "x", "id") == "id" and tables.first_existing(df, "x") is None
    s = tables.synthetic(spark, 100)
    assert s.count() == 100 and s.exceptAll(tables.synthetic(spark, 100)).count() == 0
    assert tables.base_url("https://data.example.org/x/", "d") == "https://data.example.org/x"
    assert all(tables.base_url(v, "d") == "d" for v in ("javascript:x", "https://x'y", "https://a\\b", "https://a b", None, ""))
    assert tables.resolve("/current/wide.parquet", {"wide": "wide_2026.parquet"}, "http://h/") == "http://h/wide_2026.parquet"
    with pytest.raises(KeyError):
        tables.resolve("none", {}, "x")


def test_replace_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.range(5), path, "id")

    def refuse(df):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.replace(spark.range(9), path, "id", check=refuse)
    assert spark.read.parquet(path).count() == 5 and sorted(os.listdir(tmp_path)) == ["t"]
    sinks.replace(spark.range(9), path, "id", check=lambda d: None)
    assert spark.read.parquet(path).count() == 9
    with pytest.raises(ValueError, match="input"):
        sinks.replace(spark.range(1), path, source=path + "/")
    sinks.write(spark.range(3), str(tmp_path / "z"), "id", level=9)
    assert spark.read.parquet(str(tmp_path / "z")).count() == 3


def test_manifest_comparisons(tmp_path):
    assert sinks.pinned_against(["a", "b"], ["b", "c"]) == {"missing": ["a"], "extra": ["c"]}
    assert sinks.drift({"a": '"1"'}, {"a": "1"}) == (0, []) and sinks.drift({"a": "1"}, {"a": "2"}) == (1, ["a"]) and sinks.drift({"a": "1"}, {}) == (2, ["a"])
    sinks.save_json({"x": 1}, str(tmp_path / "m.json"))
    assert os.listdir(tmp_path) == ["m.json"]


TTL = """@prefix skos: <http://www.w3.org/2004/02/skos/core#> .
@prefix m: <http://x/m/> .
m:rock a skos:Concept ; skos:prefLabel "Rock"@en, "Roche"@fr ; skos:altLabel "Stone"@en ;
  skos:broader m:material, m:also ; skos:inScheme m:s ; skos:definition "hard \\"stuff\\""@en . # note
m:material a skos:Concept; skos:prefLabel "Material"@en ; skos:note [ a m:y ; m:z 1.5 ] .
<http://x/m/s> a skos:ConceptScheme .
"""


def test_vocabulary(spark):
    got = {(r.uri, r.lang): r for r in vo.read(spark, {"a.ttl": TTL}, [("http://x/m/", "1.0", False)], overrides={"http://x/o": "Over"}).collect()}
    r = got["http://x/m/rock", "en"]
    assert (r.pref_label, r.broader, r.broader_count, r.definition, r.alt_labels) == ("Rock", "http://x/m/also", 2, 'hard "stuff"', ["Stone"])
    assert got["http://x/m/1.0/rock", "fr"].uri_form == "data_v1" and got["http://x/o", "en"].pref_label == "Over"
    assert ("http://x/m/s", None) not in got
    assert vo.data_forms("http://b/fungi", [("http://b/", "1.0", True)]) == ["http://b/1.0/Fungi", "http://b/1.0/fungi"] and vo.data_forms("http://b/1.0/x", [("http://b/", "1.0", True)]) == []
    page = vo.markdown(vo.concept_rows(TTL, "a"))
    assert page.startswith("- [Material]") and "## Rock" in page and "Also: Stone" in page


def test_the_preferred_file_describes_a_concept(spark):
    other = TTL.replace('"Rock"', '"Other"')
    names = lambda hints: {r.pref_label for r in vo.read(spark, {"a.ttl": other, "b.ttl": TTL}, hints=hints).filter("uri = 'http://x/m/rock' and lang = 'en'").collect()}
    assert names([]) == {"Other"} and names([("/m/", "b.ttl")]) == {"Rock"}


def test_newer_requests_void_older_ones(spark):
    g = Generation(spark, "panel")
    assert g.run(lambda: 5) == 5
    old = []

    def slow():
        time.sleep(0.5)
        return spark.range(10).count()

    t = threading.Thread(target=lambda: old.append(g.run(slow)))
    t.start()
    time.sleep(0.1)
    assert g.run(lambda: 7) == 7
    t.join()
    assert old == [None]


def test_the_rest_works_without_the_subpackage(tmp_path):
    for name in ("corelode", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(src) else shutil.copy(src, tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 50 and 'pipeline' not in n and not any(x.startswith('op') for x in n if x[2:3].isdigit()); assert set(e.oracle_sql()) <= set(n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_entry(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


VOCABULARY = """
@prefix skos: <http://www.w3.org/2004/02/skos/core#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
@prefix m: <http://v/m/> .
m:any a skos:Concept ; skos:prefLabel "Anything" ; skos:definition "Alles"@de, "Everything"@en .
m:rock a skos:Concept ; skos:prefLabel "Rock"@en, "Gestein"@de ; skos:broader m:any .
m:ore a skos:Concept ; rdfs:label "Ore" ; skos:broader m:rock, <http://other/x> .
m:dust a skos:Concept ; skos:broader <http://other/x> .
"""
SECOND = """
@prefix skos: <http://www.w3.org/2004/02/skos/core#> .
<http://v/m/rock> a skos:Concept ; skos:prefLabel "Stone"@en ; skos:altLabel "Pebble" .
"""


def test_each_form_of_a_vocabulary_is_a_tree(spark):
    t = vo.read(spark, {"a": SECOND, "b": VOCABULARY}, roots=[("http://v/m/", "1.0", False)], hints=[("/m/", "b")])
    rows = {(r.uri, r.lang): r for r in t.collect()}
    rock = rows["http://v/m/1.0/rock", "en"]
    assert (rock.broader, rock.uri_form, rock.alt_labels) == ("http://v/m/1.0/any", "data_v1", ["Stone"])
    assert rows["http://v/m/rock", "en"].broader == "http://v/m/any" and rows["http://v/m/1.0/rock", "de"].pref_label == "Gestein"
    ore = rows["http://v/m/1.0/ore", "en"]
    assert (ore.pref_label, ore.broader, ore.broader_count) == ("Ore", "http://other/x", 2)
    assert rows["http://v/m/any", "en"].definition == "Everything" and rows["http://v/m/dust", None].pref_label is None
    have = {r.uri for r in rows.values() if r.uri_form == "data_v1"}
    assert all(r.broader in have | {None, "http://other/x"} for r in rows.values() if r.uri_form == "data_v1")


class Disk:
    """A file system of names, whose renames onto ``bad`` names return false."""

    def __init__(self, names, bad=()):
        self.names, self.bad = dict(names), list(bad)

    def exists(self, p):
        return p in self.names

    def rename(self, a, b):
        if a not in self.names or b in self.names or (a, b) in self.bad:
            return False
        self.names[b] = self.names.pop(a)
        return True

    def delete(self, p, _):
        return self.names.pop(p, None) is not None


def test_a_failed_rename_keeps_the_old_table():
    good = Disk({"t": 1, "new": 2})
    sinks.swap(good, "new", "t", "old")
    assert good.names == {"t": 2}
    for bad in ([("t", "old")], [("new", "t")]):
        disk = Disk({"t": 1, "new": 2}, bad)
        with pytest.raises(OSError):
            sinks.swap(disk, "new", "t", "old")
        assert disk.names == {"t": 1}
    stuck = Disk({"t": 1, "new": 2}, [("new", "t"), ("old", "t")])
    with pytest.raises(OSError, match="is at old"):
        sinks.swap(stuck, "new", "t", "old")
    assert stuck.names == {"old": 1, "new": 2}
    fresh = Disk({"new": 2})
    sinks.swap(fresh, "new", "t", "old")
    assert fresh.names == {"t": 2}


def test_kept_tables_are_made_once_and_again_when_they_are_gone(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(3).write.parquet(src)
    made = []
    build = lambda: (made.append(1), spark.read.parquet(src))[1]
    get = lambda: sorted(r.id for r in lineage.kept(spark, [src], "t", build).collect())
    assert get() == get() == [0, 1, 2] and len(made) == 1
    at, path = lineage.hadoop_path(spark, lineage.made_once(spark, next(k for k in lineage._kept if "t" in k)[1:], None))
    at.delete(path, True)
    assert get() == [0, 1, 2] and len(made) == 2
    spark.range(4).write.mode("overwrite").parquet(src)
    assert get() == [0, 1, 2, 3] and len(made) == 3


def test_every_core_query_but_few_has_sql():
    from corelode.plans import catalogue_build

    assert set(catalogue_build.oracle_sql()) == set(catalogue_build.queries())


def test_trees_of_any_size_close(spark):
    chains = spark.range(20_000).selectExpr("cast(id as string) as uri", "case when id % 12 > 0 then cast(id - 1 as string) end as parent_uri")
    a, b = hierarchy.closure(chains), hierarchy.closure_by_doubling(chains)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and b.count() == sum(k % 12 + 1 for k in range(20_000))
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "uri string, parent_uri string")
    assert {tuple(r) for r in hierarchy.closure_by_doubling(loop).collect()} == {tuple(r) for r in hierarchy.closure(loop).collect()}
