import random
import time
from urllib.parse import urlsplit

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import wrappers as W

SCHEMA = "page_id long, url string, html string"


def accepts(w, labels):
    """Plain backtracking recogniser of a wrapper."""

    def items(w, at):
        if not w:
            yield at
            return
        g, e = w[0][1], 1
        while g and e < len(w) and w[e][1] == g:
            e += 1
        ends = {at} if g else set()
        here = {at}
        for atom, _ in w[:e]:
            here = {y for x in here for y in one(atom, x)}
        for x in here | ends:
            yield from items(w[e:], x)

    def one(atom, at):
        if isinstance(atom, str):
            return {at + 1} if at < len(labels) and labels[at] == atom else set()
        seen, front = set(), {at}
        while front:
            front = {y for x in front for y in items(atom[1], x)} - seen
            seen |= front
        return seen

    return len(labels) in set(items(w, 0))


def test_tokens():
    labels, texts = W.tokens('<!DOCTYPE html><p class="a>b">x <!-- c -->&amp; y</p><script>var t="</p>";</script><br/>z<')
    assert labels == ["p", "#", "/p", "br", "#"] and texts == ["x & y", "z <"]


def test_lists_fold_and_mismatches_become_optional():
    pages = [f"<h1>t{n}</h1><ul>{'<li>a</li>' * n}</ul>" + ("<b>extra</b>" if n % 2 else "") for n in (1, 2, 3, 4)]
    w = W.infer([W.fold(W.tokens(p)[0]) for p in pages])
    assert W.expression(w) == "<h1> # </h1> <ul> ( <li> # </li> )+ </ul> ( <b> # </b> )?"
    for p in pages:
        labels = W.tokens(p)[0]
        assert accepts(w, labels) and W.Compiled(w).slots_of(labels) is not None
    assert W.Compiled(w).slots_of(W.tokens("<h2>x</h2>")[0]) is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "/a", "#"]), max_size=9), st.lists(st.sampled_from(["a", "b", "/a", "#"]), max_size=9))
def test_alignment_accepts_both(x, y):
    w = W.align(W.plain(x), W.plain(y))
    assert accepts(w, x) and accepts(w, y)
    c = W.Compiled(w)
    if w:
        assert c.slots_of(x) is not None and c.slots_of(y) is not None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "#"]), max_size=14))
def test_folding_accepts_the_stream(x):
    assert accepts(W.fold(x), x)


def test_wrappers_match_all_pages_of_the_table():
    t = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pandas()
    streams = {}
    for u, h in zip(t.url, t.html):
        streams.setdefault(urlsplit(u).hostname, []).append(W.tokens(h)[0])
    for mine in streams.values():
        shapes = sorted({W.fold(x) for x in mine}, key=repr)
        c = W.Compiled(W.infer(shapes))
        assert all(c.slots_of(x) is not None for x in mine)


def test_extraction_drops_the_template(spark):
    rng = random.Random(1)
    rows = [(k, "http://A.example/x", f"<div>Site name</div><p>text {rng.random()}</p>") for k in range(5)] + [(9, "http://b.example/", "<p>only page</p>")]
    got = {r.page_id: r for r in W.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[k].text.startswith("text 0.") and "Site" not in got[k].text and got[k].host == "a.example" for k in range(5))
    assert got[9].text == "only page" and all(r.matched for r in got.values())


def test_whole_table(sf):
    pages = sf("pages")
    got = W.extract(pages)
    assert got.count() == pages.count() and got.filter("not matched").count() == 0
    first = pages.orderBy("page_id").first()
    _, texts = W.tokens(first.html)
    kept = got.filter(got.page_id == first.page_id).first().text.split("\n")
    assert set(kept) <= set(texts) and len(kept) > 3


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "<p>x"), (None, "http://h/", "<p>y</p>"), (4, "http://[bad", "z"), (5, "http://h/", "<p>y</p>"), (5, "http://h/", "<p>y</p>"), (6, "http://long/", "<i>q</i>" * 30000)]
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as host", "2 as slots", "3 as fixed", "4 as wrapper")
    got = W.extract(d).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == "" and by[2] == "" and by[6].count("q") == 30000
    assert W.extract(d.limit(0)).count() == 0


def test_hosts(spark):
    rows = ["http://A.Example/x y", "https://u:p@b.example:80/?q=http://z/", "no scheme/x", None, "", "ftp://[::1]:2/", "http://c.example#f"]
    got = [r.h for r in spark.createDataFrame([(u,) for u in rows], "url string").select(W.host_of(W.F.col("url")).alias("h")).collect()]
    assert got == ["a.example", "b.example", "", "", "", "[::1]", "c.example"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.sampled_from([1, 4, 1 << 22]))
def test_alignments_are_best_at_any_table_size(x, y, cells):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + (1 + x[i] % 2 if x[i] == y[j] else 0))
    keep, W.TABLE_CELLS = W.TABLE_CELLS, cells
    try:
        got = W._matches(np.array(x, np.int32), np.array(y, np.int32), np.array([1 + v % 2 for v in x], np.int32))
    finally:
        W.TABLE_CELLS = keep
    assert sum(1 + x[i] % 2 for i, _ in got) == best[0][0]
    assert all(x[i] == y[j] for i, j in got) and all(a < c and b < d for (a, b), (c, d) in zip(got, got[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "/a", "#"]), max_size=10), min_size=1, max_size=4), st.lists(st.sampled_from(["a", "b", "/a", "#"]), max_size=10))
def test_automaton_reads_what_backtracking_reads(streams, other):
    w = W.infer([W.fold(x) for x in streams])
    c = W.Compiled(w)
    for x in [*streams, other]:
        got = c.slots_of(x)
        assert (got is not None) == (accepts(w, x) if w else not x)
        if got is not None:
            assert len(got) == x.count("#")


def test_long_repeats_and_many_groups_fold():
    row = [f"t{k}" for k in range(25)]
    assert W.expression(W.fold(row * 3)) == "( " + " ".join(f"<{x}>" for x in row) + " )+"
    many = [x for k in range(80) for n in range(2) for x in (f"g{k}", f"h{k}", "#", *["b"] * (n + 1), f"/h{k}", f"/g{k}")]
    folded = W.fold(many)
    assert len(folded) == 80 and all(not isinstance(a, str) for a, _ in folded)


def test_long_varied_pages_take_seconds(spark):
    """Pages of tens of thousands of tokens that hardly fold, on one host with short ones."""
    rng = random.Random(3)
    pages = ["".join(f"<{rng.choice('pqrstuvw')}{rng.randrange(9)}>text {k}" for k in range(n)) for n in (12000, 12000, 10)]
    began = time.time()
    w = W.infer([W.fold(W.tokens(p)[0]) for p in pages])
    assert all(W.Compiled(w).slots_of(W.tokens(p)[0]) is not None for p in pages)
    assert time.time() - began < 120


@pytest.mark.parametrize("n", [1, 2, 5])
def test_extracted_text_against_plain_reading(spark, n):
    """The template is what every page has; the rest is the content, in order."""
    pages = [(k, "http://h.example/%d" % k, "<html><b>Site name</b><h1>title %d</h1><ul>%s</ul><i>footer</i></html>" % (k, "".join(f"<li>item {k} {j}</li>" for j in range(1 + k % 3)))) for k in range(n)]
    got = {r.page_id: r.text for r in W.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    for k in range(n):
        content = [f"title {k}", *[f"item {k} {j}" for j in range(1 + k % 3)]]
        assert got[k].split("\n") == (content if n > 1 else ["Site name", *content, "footer"])
