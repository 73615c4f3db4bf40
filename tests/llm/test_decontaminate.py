import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import decontaminate as D

ITEM = "Which river flows through the old capital and under the nine stone bridges of the king"
SCHEMA = "doc_id long, text string"


def plain_sw(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = h[i - 1][j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH)
            h[i][j] = max(0, s, h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
            best = max(best, h[i][j])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), min_size=1, max_size=20))
def test_alignment_score(a, b):
    score, first, last = D.smith_waterman(np.array(a, np.uint64), np.array(b, np.uint64))
    assert score == plain_sw(a, b)
    if score:
        assert 0 <= first <= last < len(b)
        assert plain_sw(a, b[first : last + 1]) == score


@pytest.fixture(scope="module")
def cases(spark):
    edited = ITEM.replace("old", "ancient").replace("nine", "seven")
    rows = [(1, "Some words before. " + ITEM.upper() + " and after."), (2, "x y z " + edited), (3, "The king of the old river"), (4, ""), (5, None), (None, ITEM), (6, "Short one"), (7, ITEM), (7, ITEM), (8, "filler words here " * 20000 + ITEM)]
    items = [(10, ITEM), (10, ITEM), (11, "short one"), (12, ""), (13, None), (None, ITEM)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [D.BLOCK_WORDS, 17])
def test_copies_and_edited_copies_are_found(cases, limit):
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(*cases, block_words=limit).collect()}
    assert set(got) == {(1, 10), (2, 10), (6, 11), (7, 10), (8, 10)}
    assert got[1, 10] == 1.0 and 0.5 < got[2, 10] < 1.0


def test_decontaminate_keeps_the_rest(cases):
    docs = cases[0].selectExpr("*", "'x' as item_id")
    kept = D.decontaminate(docs, cases[1])
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 4, 5]


@pytest.mark.parametrize("kind", ["smallint", "string", "decimal(5,1)"])
def test_ids_of_any_type(cases, kind):
    docs, items = cases
    got = D.contaminated(docs, items.withColumn("item_id", items.item_id.cast(kind)))
    assert got.schema["item_id"].dataType == items.withColumn("item_id", items.item_id.cast(kind)).schema["item_id"].dataType
    assert {(r.doc_id, int(float(r.item_id))) for r in got.collect()} == {(1, 10), (2, 10), (6, 11), (7, 10), (8, 10)}


def test_empty_tables(spark, cases):
    docs, items = cases
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_against_aligning_everything(sf):
    """Every (document, item) pair whose full alignment reaches the score is reported."""
    from corelode.llm import scan

    docs, items = sf("documents"), sf("benchmark")
    d, b = docs.select("doc_id", "text").toArrow(), items.toArrow()
    wd, wb = scan.words(d["text"].combine_chunks()), scan.words(b["text"].combine_chunks())
    want = set()
    for r, i in enumerate(d["doc_id"].to_pylist()):
        for q, j in enumerate(b["item_id"].to_pylist()):
            item = wb.hash[wb.first[q] : wb.first[q + 1]]
            text = wd.hash[wd.first[r] : wd.first[r + 1]]
            if np.isin(item, text).mean() >= D.MIN_SCORE / 2 and D.smith_waterman(item, text)[0] / (D.MATCH * len(item)) >= D.MIN_SCORE:
                want.add((i, j))
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and got


@pytest.mark.parametrize("limit", [D.BLOCK_WORDS, 17])
def test_edited_copies_without_a_verbatim_one_or_beside_it(spark, limit):
    """Seeds do not depend on which n-grams other documents hold."""
    rng = np.random.default_rng(3)
    plain = [[f"w{q}x{k}" for k in range(30)] for q in range(12)]
    rows, want, key = [], set(), 0
    for q, words in enumerate(plain):
        if q % 2:
            rows.append((key := key + 1, " ".join(words)))
            want.add((key, q))
        rate = (0.15, 0.2, 0.25, 0.3)[q // 2 % 4]
        new = [f"e{rng.integers(10**9)}" if rng.random() < rate else w for w in words]
        rows.append((key := key + 1, "some words before " + " ".join(new) + " and some after"))
        score, _, _ = D.smith_waterman(np.arange(1, 31, dtype=np.uint64), np.array([k + 1 if a == b else 0 for k, (a, b) in enumerate(zip(new, words))], np.uint64))
        if score / (D.MATCH * 30) >= D.MIN_SCORE:
            want.add((key, q))
    docs = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame([(q, " ".join(w)) for q, w in enumerate(plain)], "item_id long, text string")
    assert len(want) > 10
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items, block_words=limit).collect()} == want
