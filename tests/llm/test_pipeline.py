import corpus_pipeline as C
from corelode.llm import decontaminate, mixing, neardup, perplexity, queries, rans

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert len(C.STAGES) == 5 and C.ORACLE_SQL is None
    assert [n for n, _ in C.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixture", "token output"]


def test_each_stage_acts_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    one = C.quality(spark, docs, SF).cache()
    want = {r.doc_id for r in perplexity.judge(docs).filter("keep").collect()}
    assert {r.doc_id for r in one.collect()} == want and one.columns == names
    two = C.near_duplicates(spark, one, SF).cache()
    assert {r.doc_id for r in two.collect()} == want - {r.doc_id for r in neardup.groups(one).collect()} and two.columns == names
    three = C.decontamination(spark, two, SF).cache()
    bad = {r.doc_id for r in decontaminate.contaminated(two, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - bad and three.columns == names
    four = C.mixture(spark, three, SF).cache()
    assert {r.doc_id for r in four.collect()} == {r.doc_id for r in mixing.mix(three).collect()} and four.columns == names
    back = {r.doc_id: rans.encoder(rans.VOCABULARY).decode(r.ids) for r in rans.read(C.run(spark, SF)).collect()}
    assert back == {r.doc_id: r.text for r in four.collect()}


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls anywhere, empty and very long texts, repeated rows, clashing columns, and no rows at all."""
    spark.createDataFrame([(1, "an item of a benchmark with some words"), (None, "x"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = " ".join(f"word{k % 97} other{k % 31}" for k in range(30000))
    rows = [(1, "some plain words here", "en", "a", 21), (1, "some plain words here", "en", "a", 21), (2, None, "en", "a", None), (3, "", None, None, 0), (None, "no id at all", "en", None, 12), (None, None, None, None, None), (4, long, "en", "b", len(long)), (5, "an item of a benchmark with some words", "en", "b", 38)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.selectExpr("*", "'x' as part", "1 as _l", "'r' as fp", "7 as keep", "map('k', 1) as root")
    for table in (docs, odd, docs.limit(0), odd.limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, table, str(tmp_path))
            got = out.collect()
            if name != "token output":
                assert out.columns == table.columns, name
            if table.isEmpty():
                assert not got, name
    ids = lambda f: sorted((r.doc_id or 0) for r in f(spark, odd, str(tmp_path)).collect())
    assert ids(C.near_duplicates) == [0, 0, 1, 2, 3, 4, 5]
    assert ids(C.decontamination) == [0, 0, 1, 1, 2, 3, 4]
    assert {0, 2, 3} <= set(ids(C.mixture))
    assert 2 not in ids(C.quality) and 3 not in ids(C.quality)


def test_one_query_for_each_operator(spark):
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    for n, q in queries.queries().items():
        assert q(spark, SF).columns, n
