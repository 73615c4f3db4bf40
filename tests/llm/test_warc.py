import gzip
import io

import pytest

from corelode.llm import warc as W


def test_records_of_members_and_of_plain_files():
    recs = [W.page_record(k, f"http://h/{k}", "x\r\n\r\n" * k) for k in range(5)]
    for data in (b"".join(W.member(r) for r in recs), b"".join(recs)):
        got = list(W.records(io.BytesIO(data)))
        assert [W.payload_of(r) for r in got] == [("x\r\n\r\n" * k).encode() for k in range(5)]
        assert all(W.verify(r.headers["warc-block-digest"], r.block) for r in got)


def test_a_record_larger_than_a_chunk_and_many_in_one_chunk():
    big = "ü" * (3 * W.CHUNK)
    data = b"".join(W.member(W.page_record(k, None, t)) for k, t in enumerate([big, "a", big, ""]))
    assert [W.payload_of(r).decode() for r in W.records(io.BytesIO(data))] == [big, "a", big, ""]
    assert gzip.decompress(data).count(b"WARC/1.1") == 4


def test_broken_files_raise_and_wrong_digests_are_told():
    good = W.member(W.page_record(1, "u", "hello"))
    for bad in (good[:-9], W.member(W.page_record(1, "u", "hello")[:-6]), W.page_record(1, "u", "hello")[:-20], b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(W.records(io.BytesIO(bad)))
    changed = W.page_record(1, "u", "hello").replace(b"hello", b"jello")
    (r,) = W.records(io.BytesIO(changed))
    assert W.verify(r.headers["warc-payload-digest"], W.payload_of(r)) is False
    assert W.verify(None, b"") is None and W.verify("crc:1", b"") is None
    assert W.verify("sha256:" + __import__("hashlib").sha256(b"x").hexdigest(), b"x") is True


def test_round_trip_of_edge_rows(spark):
    rows = [(1, "http://u/1", None), (None, None, "a\r\n\r\nb"), (2, "", ""), (2, "", ""), (3, "v", "é" * 400000), (4, "http://h/a b\n  c ", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as file")
    got = W.round_trip(spark, pages, file_records=2).collect()
    assert sorted(((r.page_id, r.url, r.html) for r in got), key=repr) == sorted(rows, key=repr)
    assert all(r.block_ok and r.payload_ok for r in got)


def test_empty_table(spark):
    assert W.round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_broken_file_may_be_tolerated(spark, tmp_path):
    good = W.member(W.page_record(1, "u", "hello"))
    (tmp_path / "a.warc.gz").write_bytes(good + W.member(W.page_record(2, "u", "cut"))[:-90])
    (tmp_path / "b.warc.gz").write_bytes(good)
    (tmp_path / "c.warc").write_bytes(b"WARC/1.1\r\nno length\r\n\r\n")
    got = sorted((r.file[-9:], r.warc_type, r.page_id) for r in W.read(spark, str(tmp_path), tolerant=True).collect())
    assert [x[1:] for x in got if x[0] == "a.warc.gz"] == [("broken", None), ("response", 1)]
    assert [x[1:] for x in got if x[0] == "b.warc.gz"] == [("response", 1)] and len(got) == 4
    with pytest.raises(Exception, match="ends inside|length"):
        W.read(spark, str(tmp_path)).collect()
