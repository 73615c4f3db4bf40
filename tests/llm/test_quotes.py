import random

from corelode.llm import quotes as Q

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "a", "Shall we meet on Friday at noon?\nBring the long report please."),
    (1, 1, "b", "On Mon, a wrote:\n> Shall we meet on Friday\n> at noon?\nYes that works for me."),
    (1, 2, "c", "> Bring the long report please.\nWhich report do you mean?"),
    (1, 3, "a", "b wrote:\n> On Mon, a wrote:\n> > Shall we meet on Friday at noon?\n> Yes that works for me.\nGood."),
    (3, 5, "z", "> Which report do you mean?\nthe second report"),
    (2, 0, "x", "Other thing entirely here."),
    (2, 1, "y", None),
]


def test_depths_and_attributions():
    assert Q.lines("x\n> y\n>> z\n> > w\n a > b") == [(0, "x"), (1, "y"), (2, "z"), (2, "w"), (0, " a > b")]
    assert Q.own_text(Q.lines(ROWS[3][3])) == "Good."
    long = "On a day that is told at length " * 40 + "somebody wrote:"
    assert Q.lines(long + "\n> x") == [(1, "x")] and Q.lines(long + "\nx") == [(0, long), (0, "x")]


def test_first_messages_may_quote_other_conversations_and_circles_open(spark):
    rows = [
        (1, 7, "a", "A sentence of the older conversation."),
        (2, 0, "b", "> A sentence of the older conversation.\nA new conversation about it."),
        (3, 0, "c", "> The other one of these two.\nThe first one of these two."),
        (4, 0, "d", "> The first one of these two.\nThe other one of these two."),
    ]
    got = [(r.thread_id, r.position, r.depth, r.conv_id) for r in Q.threads(spark.createDataFrame(rows, SCHEMA)).orderBy("thread_id", "position").collect()]
    assert sorted(x[3] for x in got) == [1, 2, 3, 4]
    assert {x[:3] for x in got if x[3] == 2} == {(1, 1, 1)} and [x[2:] for x in got if x[0] == 3] == [(0, 3), (1, 4)]


def test_order_holds_every_message_once():
    rng = random.Random(8)
    for _ in range(300):
        rows = sorted({(rng.randrange(3), rng.randrange(4)) for _ in range(rng.randint(1, 9))}, key=lambda r: (r[1], r[0]))
        rows = [(c, t, *(rng.choice(rows) if rng.random() < 0.7 else (None, None))) for c, t in rows]
        assert sorted(k for k, _ in Q.order(rows)) == list(range(len(rows)))


def test_threads(spark):
    got = [(r.thread_id, r.position, r.conv_id, r.turn, r.parent_turn, r.text) for r in Q.threads(spark.createDataFrame(ROWS, SCHEMA)).orderBy("thread_id", "position").collect()]
    assert got == [
        (1, 0, 1, 0, None, ROWS[0][3]),
        (1, 1, 1, 1, 0, "Yes that works for me."),
        (1, 2, 1, 3, 1, "Good."),
        (1, 3, 1, 2, 0, "Which report do you mean?"),
        (1, 4, 3, 5, 2, "the second report"),
        (2, 0, 2, 0, None, ROWS[5][3]),
        (2, 1, 2, 1, None, None),
    ]


def brute_parent(rows, k):
    """The source of a message by comparing every quoted unit with every own unit."""
    c, t, _, text = rows[k]
    score = {}
    for d, u in {x for x in Q.units(Q.lines(text)) if x[0] > 0}:
        here = {(rc, rt) for rc, rt, _, rx in rows if rc == c and rt < t and (0, u) in Q.units(Q.lines(rx))}
        every = [(rt, rc) for rc, rt, _, rx in rows if rc != c and (0, u) in Q.units(Q.lines(rx))]
        far = {(min(every)[1], min(every)[0])} if every else set()
        for x in here or far:
            key = (d, x)
            score[key] = score.get(key, 0) + len(u)
    best = min(((d, x[0] != c, -n, -x[1], x[0]) for (d, x), n in score.items()), default=None)
    return None if best is None else (best[4], -best[3])


def test_links_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in range(8):
        for t in range(6):
            own = [" ".join(rng.choice("red blue green cold warm tall small".split()) for _ in range(4)) for _ in range(2)]
            quoted = []
            for _ in range(rng.randint(0, 2)):
                if rows:
                    src = rng.choice(rows)[3].split("\n")
                    quoted.append("> " + rng.choice(src))
            rows.append((c, t, "r", "\n".join(quoted + own)))
    m = Q._numbered(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    up = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in m.join(Q.parents(m, Q.links(m)), "mid").collect()}
    want = {(r[0], r[1]): p for k, r in enumerate(rows) if (p := brute_parent(rows, k))}
    assert up == want and len(want) > 10
    out = Q.threads(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows) and not any(x.startswith(">") for r in out for x in r.text.split("\n"))


def test_without_quotes_the_turns_stay(sf):
    c = sf("conversations")
    got = Q.threads(c)
    assert got.select("conv_id", "turn", "role", "text").exceptAll(c.select("conv_id", "turn", "role", "text")).count() == 0
    assert got.count() == c.count() and got.filter("position <> turn").count() == 0


def test_edge_rows(spark):
    rows = [(None, 1, "q", "alone"), (4, None, "q", None), (5, 0, "r", ""), (5, 0, "r", ""), (6, 0, None, "> all quoted text here"), (7, 0, "x", "word " * 100000), (7, 1, "x", "> " + "word " * 100000)]
    d = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as mid", "2 as root", "3 as hash")
    got = Q.threads(d).collect()
    assert len(got) == len(rows)
    assert next(r for r in got if r.conv_id == 6).text == ""
    assert next(r for r in got if r.conv_id == 7 and r.turn == 1).parent_turn == 0
    assert Q.threads(d.limit(0)).count() == 0
