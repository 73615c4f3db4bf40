import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corelode.llm import perplexity as P

DOCS = [
    (1, "the cat sat on the mat and the dog sat too", "en"),
    (2, "the dog ate the mat, 12 times", "en"),
    (3, "le chat est là", "fr"),
    (4, "", "en"),
    (5, None, "en"),
    (6, "no language", None),
    (6, "no language", None),
    (7, "!!!", "en"),
]


def mapped(text):
    return bytes(P._MAP[b] for b in text.encode())


def brute(texts, order=P.ORDER):
    """Log probability of every byte by the textbook formulas."""
    data = [bytes([P.BOS] * (order - 1)) + mapped(t) for t in texts if t]
    counts = {order: Counter(d[i : i + order] for d in data for i in range(len(d) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut, ctx = {}, {}
    for n, c in counts.items():
        t = [sum(v == k for v in c.values()) for k in range(6)]
        y = t[1] / max(1, t[1] + 2 * t[2])
        d = {k: max(0.0, min(k, k - (k + 1) * y * t[k + 1] / max(1, t[k]))) for k in (1, 2, 3)}
        cut[n] = lambda v, d=d: min(d[min(v, 3)], v)
        total, freed = defaultdict(int), defaultdict(float)
        for g, v in c.items():
            total[g[:-1]] += v
            freed[g[:-1]] += cut[n](v)
        ctx[n] = (total, freed)

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 256
        total, freed = ctx[n]
        low = p(g[1:])
        v = counts[n].get(g, 0)
        if g[:-1] not in total:
            return low
        return ((v - cut[n](v) if v else 0) + freed[g[:-1]] * low) / total[g[:-1]]

    return p


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string")


def nll(p, text, order=P.ORDER):
    d = bytes([P.BOS] * (order - 1)) + mapped(text)
    total = sum(math.log(p(d[i : i + order])) for i in range(len(d) - order + 1))
    return -total / max(1, int(sum(P._UNIT[b] for b in text.encode())))


def test_scores_equal_the_textbook_model(spark, docs):
    model = P.fit(P.count_ngrams(docs)).cache()
    p = brute([t for _, t, lang in DOCS if lang == "en"])
    other = spark.createDataFrame([(1, DOCS[0][1], "en"), (2, "the zebra sat", "en"), (3, "xq", "en")], "doc_id long, text string, lang string")
    want = {1: nll(p, DOCS[0][1]), 2: nll(p, "the zebra sat"), 3: nll(p, "xq")}
    got = {r.doc_id: r.log_ppl for r in P.score(other, model).collect()}
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-5), k


@pytest.mark.parametrize("pieces", [1, 13])
def test_judged_scores_equal_the_textbook_model(docs, pieces):
    """Ties, repeated rows and a very long text, in one part or spread over several."""
    long = ("the cat and the dog sat on a mat, " * 3000)[:-2]
    more = docs.union(docs.sparkSession.createDataFrame([(8, long, "en"), (9, DOCS[0][1], "en"), (9, DOCS[0][1], "en")], docs.schema))
    texts = defaultdict(list)
    rows = more.collect()
    for r in rows:
        texts[r.lang or P.UNKNOWN].append(r.text)
    p = {k: brute(v) for k, v in texts.items()}
    got = P.judge(more.repartition(pieces)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text:
            assert r.log_ppl == pytest.approx(nll(p[r.lang or P.UNKNOWN], r.text), rel=1e-5)
    assert len({(r.perplexity, r.keep) for r in got if r.doc_id in (1, 9)}) == 1


def test_decision_by_plain_medians(docs):
    """Bands and decisions against medians taken over Python lists."""
    import statistics

    sf = docs.sparkSession.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = P.judge(sf).collect()
    for lang in {r.lang for r in rows}:
        mine = [r for r in rows if r.lang == lang and r.perplexity is not None]
        centre = statistics.median(round(math.log(r.perplexity), 4) for r in mine)
        spread = 1.4826 * statistics.median(round(abs(math.log(r.perplexity) - centre) * math.sqrt(max(1, r.n_units)), 4) for r in mine)
        for r in mine:
            unit = spread / math.sqrt(max(1, r.n_units))
            low, high = centre * (1 - P.SLACK) - P.Z_LOW * unit, centre * (1 + P.SLACK) + P.Z_HIGH * unit
            x = math.log(r.perplexity)
            if min(abs(x - low), abs(x - high)) > 1e-3:
                assert r.keep == (low <= x <= high)


def test_edge_rows(docs):
    out = P.judge(docs.withColumn("keep", F.lit("clash"))).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(DOCS)
    assert by[4].perplexity is None and not by[4].keep
    assert by[5].perplexity is None and not by[5].keep
    assert by[7].n_units == 0 and by[7].perplexity is not None
    assert sum(r.doc_id == 6 for r in out) == 2


def test_keep_in_band_leaves_the_columns(docs):
    odd = docs.withColumn("perplexity", F.lit("mine"))
    got = P.keep_in_band(odd)
    assert got.columns == odd.columns
    assert {r.perplexity for r in got.collect()} <= {"mine"}


def test_empty_table(docs):
    assert P.keep_in_band(docs.limit(0)).count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    j = P.judge(d.select("doc_id", "text", "lang")).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in j}
    assert kept[1] == 1.0 and kept[0] < 0.5


def test_sorted_hashes_find_what_is_there():
    import numpy as np

    from corelode.llm.scan import mix

    keys = mix(np.arange(1000, dtype=np.uint64))
    t = P.SortedHashes(keys, np.arange(1000, dtype=np.float32))
    assert t.values[0][t.find(keys)].tolist() == list(range(1000))
    assert np.isnan(t.values[0][t.find(mix(np.arange(2000, 3000, dtype=np.uint64)))]).all()


def test_pieces_of_a_long_text_are_the_whole(monkeypatch):
    import numpy as np
    import pyarrow as pa

    text = pa.array(["é one 2 three!\n" * 40])
    (whole,) = P._codes(text, 5)
    monkeypatch.setattr(P, "PIECE_BYTES", 7)
    pieces = list(P._codes(text, 5))
    assert len(pieces) > 50 and np.array_equal(np.concatenate([c for c, _, _ in pieces]), whole[0]) and sum(n[0] for _, _, n in pieces) == whole[2][0]
