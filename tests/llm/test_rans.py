import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import rans as R

pytestmark = pytest.mark.skipif(not R.installed(), reason="no tokenizer library")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.sampled_from([1, 3, 8]), st.sampled_from([1, 4]))
def test_round_trip(tokens, lanes, stride):
    t = np.array(tokens, np.uint16)
    table = R.Table(R.scale(np.bincount(t, minlength=41), 10), 10)
    payload, marks = R.encode(t, table, lanes, stride)
    assert R.decode(payload, marks, len(t), table, lanes, stride).tolist() == tokens
    count = len(marks) // (16 + 8 * lanes)
    parts = [R.decode(payload, marks, len(t), table, lanes, stride, k, k + 1) for k in range(count)]
    assert np.concatenate([np.zeros(0, np.uint16), *parts]).tolist() == tokens


def test_size_is_close_to_the_entropy():
    rng = np.random.default_rng(0)
    p = rng.pareto(1, 2000)
    p /= p.sum()
    t = rng.choice(2000, 300_000, p=p).astype(np.uint16)
    table = R.Table(R.scale(np.bincount(t, minlength=2000)))
    assert int(table.freq.sum()) == 1 << R.BITS and int(table.freq.min()) >= 1
    q = np.bincount(t, minlength=2000) / len(t)
    bits = -(q[q > 0] * np.log2(q[q > 0])).sum() * len(t)
    assert len(R.encode(t, table)[0]) * 8 < 1.02 * bits + 64 * R.LANES


@pytest.fixture(scope="module")
def coded(spark):
    rows = [(1, "Hello, it's 12 o'clock."), (2, None), (3, ""), (1, "Hello, it's 12 o'clock."), (None, "né <|endoftext|>"), (4, "long text " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    return rows, R.blocks(docs.selectExpr("*", "1 as kind", "2 as n"), block_tokens=20).cache()


def test_documents_come_back(coded):
    rows, blocks = coded
    enc = R.encoder(R.VOCABULARY)
    got = sorted((r.doc_id or 0, enc.decode(r.ids)) for r in R.read(blocks).collect())
    assert got == sorted((i or 0, t or "") for i, t in rows)
    assert blocks.count() > 1


def test_a_broken_block_is_noticed(spark, coded):
    _, blocks = coded
    for change in ("crc32 + 1 as crc32", "reverse(doc_ids) as doc_ids", "reverse(lengths) as lengths", "unhex(hex(concat(payload, payload))) as payload", "token_crc32 + 1 as token_crc32"):
        name = change.split()[-1]
        bad = blocks.selectExpr(*[change if c == name else c for c in blocks.columns])
        with pytest.raises(Exception, match="match"):
            R.read(bad).collect()


def test_the_output_decodes_after_a_round_through_files(spark, coded, tmp_path):
    """Nothing but the rows themselves is needed."""
    rows, blocks = coded
    blocks.write.parquet(str(tmp_path / "b"))
    enc = R.encoder(R.VOCABULARY)
    got = sorted((r.doc_id or 0, enc.decode(r.ids)) for r in R.read(spark.read.parquet(str(tmp_path / "b"))).collect())
    assert got == sorted((i or 0, t or "") for i, t in rows)
    assert [r.n_tokens for r in blocks.filter(f"block_id = {R.HEADER}").collect()] == [enc.n_vocab]


def test_vocabularies_beyond_16_bits(spark, tmp_path):
    import base64

    more = "\n".join(f"{base64.b64encode(t).decode()} {n}" for n, t in enumerate([*(bytes([b]) for b in range(256)), *(b"%c%c%c" % (x, y, z) for x in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNO" for y in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNO" for z in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNO")]))
    path = tmp_path / "wide.tiktoken"
    path.write_text(more)
    enc = R.encoder(str(path))
    assert enc.n_vocab > 1 << 16
    docs = spark.createDataFrame([(1, "plain bytes"), (2, "OOO")], "doc_id long, text string")
    got = {r.doc_id: enc.decode(r.ids) for r in R.read(R.blocks(docs, vocabulary=str(path))).collect()}
    assert got == {1: "plain bytes", 2: "OOO"}


def test_empty_table_and_unseen_tokens(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.blocks(docs).count() == 0 and R.read(R.blocks(docs)).count() == 0
    table = R.Table(R.scale(np.zeros(100, np.int64)))
    t = np.arange(100, dtype=np.uint16)
    assert R.decode(*R.encode(t, table), 100, table).tolist() == t.tolist()


def test_whole_table(sf):
    docs = sf("documents")
    blocks = R.blocks(docs)
    enc = R.encoder(R.VOCABULARY)
    assert {r.doc_id: enc.decode(r.ids) for r in R.read(blocks).collect()} == {r.doc_id: r.text for r in docs.collect()}
