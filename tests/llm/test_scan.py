import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import scan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé 1.,\n", max_size=30)), max_size=6))
def test_words_agree_with_a_regular_expression(texts):
    w = scan.words(pa.array(texts, pa.string()))
    plain = [(r, x) for r, t in enumerate(texts) for x in re.findall(r"[^\W_]+", (t or "").lower())]
    assert [r for r, _ in plain] == w.row.tolist()
    ids = {}
    for (_, x), h in zip(plain, w.hash.tolist()):
        assert ids.setdefault(x, h) == h
    assert len(set(ids.values())) == len(ids)


def test_slices_cover_all_rows_and_leave_long_texts_whole():
    texts = pa.array(["x" * 10, None, "y" * 500, "", "z"])
    got = list(scan.slices(texts, limit=50))
    assert got[0][0] == 0 and got[-1][1] == 5
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))


def test_shingles_do_not_cross_texts():
    w = scan.words(pa.array(["a b", "c d e"]))
    at, h = scan.shingles(w, 2)
    assert at.tolist() == [0, 2, 3] and len(set(h.tolist())) == 3


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(scan.mix(x))) == len(x)
