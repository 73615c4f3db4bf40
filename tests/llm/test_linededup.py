import random
import re
from collections import defaultdict

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import linededup as L

PASSAGE = "\n".join(f"shared line number {k} with words" for k in range(12))
SCHEMA = "doc_id long, text string"


M64 = 2**64 - 1


def mix(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M64
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M64
    return h ^ h >> 31


def line_hash(line):
    x, power = 0, 1
    for b in line:
        x, power = (x + (b + 1) * power) & M64, power * (0x9E3779B97F4A7C15 | 1) & M64
    return mix((x + len(line)) & M64)


def plain_units(text):
    """(first line, lines) of every unit, and the lines, worked out one line at a time."""
    lines = text.encode().split(b"\n")
    if lines[-1] == b"":
        lines.pop()
    h = [line_hash(x) for x in lines]
    roll = [M64] + [mix((h[i] * 0x100000001B3 + h[i - 1]) & M64) for i in range(1, len(h))]
    cuts = [i for i in range(1, len(h)) if roll[i] < roll[i - 1] and (i + 1 == len(h) or roll[i] <= roll[i + 1])]
    edges = [0, *[i + 1 for i in cuts]] + ([len(h)] if not cuts or cuts[-1] + 1 < len(h) else [])
    units = {(x, y - x) for x, y in zip(edges, edges[1:]) if y - x > 1}
    words = [len([w for w in re.split(rb"[\x00-\x20]+", x) if w]) for x in lines]
    units |= {(i, 2) for i in range(len(h) - 1) if words[i] + words[i + 1] >= L.PAIR_WORDS}
    units |= {(i, 1) for i in range(len(h)) if words[i] > L.LINE_WORDS}
    return units, lines


def brute(rows):
    """Group all units by their bytes; the first of each group stays, the lines of the others go."""
    places, found = defaultdict(set), []
    for i, t in rows:
        units, lines = plain_units(t) if i is not None and t else ([], [])
        found.append((units, lines))
        for at, n in units:
            places[b"\n".join(lines[at : at + n])].add((i, at))
    out = []
    for (i, t), (units, lines) in zip(rows, found):
        gone = {x for at, n in units if min(places[b"\n".join(lines[at : at + n])]) != (i, at) for x in range(at, at + n)}
        out.append((i, b"\n".join(x for k, x in enumerate(lines) if k not in gone).decode() if gone else t))
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab\n", max_size=20), max_size=5))
def test_chunks_partition_texts(texts):
    c = L.Chunks(pa.array(texts, pa.string()))
    for r, t in enumerate(texts):
        mine = [k for k in range(len(c.row)) if c.row[k] == r]
        assert b"".join(c.raw[c.begin[k] : c.end[k]].tobytes() for k in mine).decode() == t
        assert [int(c.seq[k]) for k in mine] == list(range(len(mine)))
        assert all(c.lines[k] > 1 for k in mine[1:-1])


def test_boundaries_move_with_the_text():
    a = L.Chunks(pa.array([PASSAGE]))
    b = L.Chunks(pa.array(["new first line\n" + PASSAGE]))
    assert len(set(a.hash.tolist()) & set(b.hash.tolist())) >= len(a.hash) - 2


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = dict(brute([tuple(r) for r in docs.collect()]))
    got = {r.doc_id: r.text for r in L.clean(docs).collect()}
    assert got == want and any(want[r.doc_id] != r.text for r in docs.collect())


def test_edge_rows(spark):
    rows = [(1, "intro one\n" + PASSAGE), (2, PASSAGE + "\noutro"), (2, PASSAGE + "\noutro"), (3, None), (4, ""), (None, PASSAGE), (5, "single line"), (6, "single line"), (7, "\n\n\n"), (8, "x\ny\n" * 20000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 as gone", "8 as removed_lines", "'k' as seq")
    out = L.clean(docs)
    assert set(out.columns) == set(docs.columns)
    got = out.collect()
    assert len(got) == len(rows)
    text = defaultdict(list)
    for r in got:
        text[r.doc_id].append(r.text)
    assert text[3] == [None] and text[4] == [""] and text[None] == [PASSAGE]
    assert text[5] == text[6] == ["single line"]
    assert text[1] == [rows[0][1]] and text[2][0] == text[2][1] and len(text[2][0]) < len(PASSAGE)


def test_empty_table(spark):
    assert L.clean(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=60), max_size=6))
def test_units_against_plain_python(texts):
    c = L.Chunks(pa.array(texts, pa.string()))
    got = defaultdict(set)
    for k in range(len(c.unit_hash)):
        got[int(c.unit_row[k])].add((c.place(k), int(c.unit_lines[k]), c.unit(k)))
    for r, t in enumerate(texts):
        units, lines = plain_units(t) if t else (set(), [])
        assert got[r] == {(at, n, b"\n".join(lines[at : at + n])) for at, n in units}


def test_passages_of_over_fifty_words_stay_once(spark):
    """Of a passage of one to six lines inside other text one copy is left, wherever chunks end."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    passages = [[line(-(-51 // k)) for _ in range(k)] for k in range(1, 7) for _ in range(4)]
    rows = []
    for p in passages:
        for _ in range(3):
            rows.append((len(rows), "\n".join([*[line(12) for _ in range(rng.randrange(5))], *p, *[line(12) for _ in range(rng.randrange(5))]])))
    got = {r.doc_id: r.text for r in L.clean(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    for k, p in enumerate(passages):
        where = [i for i in got if any(x in got[i] for x in p)]
        assert where == [3 * k] and "\n".join(p) in got[3 * k]
        for i in range(3 * k, 3 * k + 3):
            assert all(x in got[i].split("\n") for x in rows[i][1].split("\n") if x not in p)
