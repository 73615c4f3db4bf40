import numpy as np
import pyarrow as pa
import pytest

from corelode.llm import neardup as N

TEXT = " ".join(f"word{k * 7919 % 1000} alpha{k}" for k in range(60))


def brute_groups(ids, fp):
    bits = np.unpackbits(fp, axis=1).astype(int)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (bits[a] != bits[b]).sum() <= N.MAX_BITS and (fp[a] == fp[b]).sum() >= N.MIN_SHARED:
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: find(i) for i in ids if find(i) != i}


def test_simhash_against_plain_sums():
    from corelode.llm import scan

    texts = pa.array([TEXT, "one two three four", None, "x"])
    fp = N.simhash(texts)
    w = scan.words(texts.slice(0, 1))
    h = np.unique(w.hash[(w.end - w.start) >= N.MIN_WORD])
    for k in range(4):
        x = scan.mix(h + np.uint64(k * 0x51ED270B9F3))
        for b in range(64):
            ones = int(((x >> np.uint64(b)) & np.uint64(1)).sum())
            assert (fp[0, k * 8 + b // 8] >> (b % 8)) & 1 == (ones * 2 > len(h))


def test_recall_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    t = N.fingerprints(docs).toArrow()
    ids = t["doc_id"].to_pylist()
    want = brute_groups(ids, np.frombuffer(b"".join(t["fp"].to_pylist()), np.uint8).reshape(-1, N.BYTES))
    got = {r.doc_id: r.dup_of for r in N.groups(docs).collect()}
    assert got == want


def _roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in pairs:
        root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def _searched(words):
    raw, got = words.view(np.uint8).reshape(len(words), N.BYTES), []
    for p, q in N.pair_keys(list(range(N.BYTES)), N.MIN_SHARED):
        key = raw[:, p].astype(np.int64) * 256 + raw[:, q]
        order = np.argsort(key, kind="stable")
        for m in N.links(key[order], words[order], [x for x in range(N.BYTES) if x not in (p, q)], N.MIN_SHARED - 2):
            got += order[m].tolist()
    return got


@pytest.mark.parametrize("short", [2, 8, 256])
@pytest.mark.parametrize("flips", [(1, 3), (1, 40), (15, 30)])
def test_search_finds_what_all_pairs_find(monkeypatch, short, flips):
    """Lists split at any length, dense or not, give the groups of all pairs."""
    monkeypatch.setattr(N, "SHORT", short)
    rng = np.random.default_rng(short + flips[1])
    base = rng.integers(0, 256, (5, N.BYTES), dtype=np.uint8)
    bits = np.unpackbits(base[rng.integers(0, 5, 400)], axis=1)
    for r in range(400):
        bits[r, rng.choice(256, rng.integers(*flips), replace=False)] ^= 1
    words = np.packbits(bits, axis=1).view(np.uint64)
    want = [(i, j) for i in range(400) for j in np.flatnonzero(N.near(words[:i], words[i]))]
    got = _searched(words)
    assert {tuple(sorted(p)) for p in got} <= {(int(j), i) for i, j in want}
    a, b = _roots(400, want), _roots(400, got)
    assert len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_count_filter_rejects_and_keys_cover_every_choice():
    x = np.zeros((1, 4), np.uint64)
    y = x.copy()
    y.view(np.uint8)[0, : N.BYTES - N.MIN_SHARED + 1] = 1  # few bits, but too few equal bytes
    assert np.bitwise_count(x ^ y).sum() <= N.MAX_BITS and N.equal_bytes(x ^ y)[0] == N.MIN_SHARED - 1 and not N.near(x, y)[0]
    rng = np.random.default_rng(3)
    for minimum, of in ((9, 32), (7, 30), (3, 26), (2, 25)):
        keys = N.pair_keys(list(range(of)), minimum)
        for _ in range(500):
            chosen = set(rng.choice(of, minimum, replace=False).tolist())
            assert any(p in chosen and q in chosen for p, q in keys)


def test_equal_bytes_and_words(spark):
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 256, (50, N.BYTES), dtype=np.uint8)
    other = np.where(rng.random(fp.shape) < 0.5, fp, rng.integers(0, 256, fp.shape, dtype=np.uint8)).astype(np.uint8)
    assert N.equal_bytes(fp.view(np.uint64) ^ np.ascontiguousarray(other).view(np.uint64)).tolist() == (fp == other).sum(axis=1).tolist()
    rows = N._as_words(spark.createDataFrame([(i, bytearray(f.tobytes())) for i, f in enumerate(fp)], "rep long, fp binary")).orderBy("rep").collect()
    assert np.array([[r[w] for w in N.WORDS] for r in rows]).view(np.uint64).tolist() == fp.view(np.uint64).tolist()
    row = N._postings(spark.createDataFrame([rows[0]])).collect()
    keys = N.pair_keys(list(range(N.BYTES)), N.MIN_SHARED)
    assert [r.key for r in row] == [(k << 16) + int(fp[0, p]) * 256 + int(fp[0, q]) for k, (p, q) in enumerate(keys)]


def test_edge_rows(spark):
    rows = [(1, TEXT), (2, TEXT + " extra"), (2, TEXT + " extra"), (3, None), (4, None), (5, ""), (6, ""), (None, TEXT), (7, "?!"), (8, "another text entirely " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "y")
    got = {r.doc_id: r.dup_of for r in N.groups(docs).collect()}
    assert got == {2: 1, 6: 5}
    kept = sorted((r.doc_id or 0) for r in N.deduplicate(docs).collect())
    assert kept == [0, 1, 3, 4, 5, 7, 8]


def test_repeated_ids_keep_one_row_and_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", "r", {"k": 1}), (1, "alpha beta gamma", "a", {"k": 2}), (1, "beta", "z", None)], "doc_id long, text string, root string, extra map<string,int>")
    got = N.deduplicate(docs)
    assert got.columns == docs.columns and [(r.root, r.extra) for r in got.collect()] == [("a", {"k": 2})]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert N.groups(docs).count() == 0 and N.deduplicate(docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 40])
def test_components_of_a_chain(spark, n):
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)], "a long, b long")
    assert {(r.node, r.root) for r in N.components(edges).collect()} == {(k, 0) for k in range(n + 1)}


def test_recall_against_text_similarity(spark):
    """Texts that share half of their word 4-grams end in one group, whatever the fingerprints say."""
    from corelode.llm import scan

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    t = docs.toArrow()
    ids, texts = t["doc_id"].to_pylist(), t["text"].to_pylist()
    grams = [set(scan.shingles(scan.words(pa.array([x], pa.string())), 4)[1].tolist()) for x in texts]
    at = {}
    for k, g in enumerate(grams):
        for x in g:
            at.setdefault(x, []).append(k)
    first = {}
    for k, x in enumerate(texts):
        first.setdefault(x, k)
    pairs = {(a, b) for ks in at.values() for a in ks for b in ks if a < b and texts[a] != texts[b]}
    near = [(a, b) for a, b in pairs if len(grams[a] & grams[b]) >= 0.5 * len(grams[a] | grams[b])]
    group = {r.doc_id: r.dup_of for r in N.groups(docs).collect()}
    apart = [(a, b) for a, b in near if group.get(ids[a], ids[a]) != group.get(ids[b], ids[b])]
    assert near and len(apart) <= 0.05 * len(near)


def test_forest_keeps_components():
    rng = np.random.default_rng(7)
    names = [bytes([k]) * 4 for k in range(60)]
    pairs = rng.integers(0, 60, (70, 2)).tolist()
    forest = N.Forest()
    forest.add([names[i] for i, _ in pairs], [names[j] for _, j in pairs])
    stars = [(names.index(a), names.index(b)) for t in forest.stars(rows=7) for a, b in zip(t["a"].to_pylist(), t["b"].to_pylist())]
    want, got = _roots(60, pairs), _roots(60, stars)
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got)) and len(stars) == 60 - len(set(want))
