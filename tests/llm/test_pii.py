import ipaddress
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corelode.llm import pii as P

NAMES = P.Pseudonyms(b"k")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 73049])
def test_feistel_is_a_permutation(size):
    f = P.Feistel(b"k", "t", size)
    image = [f.forward(v) for v in range(min(size, 2000))]
    assert len(set(image)) == len(image) and all(0 <= v < size for v in image)
    assert [f.inverse(v) for v in image] == list(range(len(image)))


VALUES = {
    "card": ["4111 1111 1111 1111", "4785380592391139", "378282246310005"],
    "phone": ["+1 (017) 555-7713", "555-123-4567"],
    "ipv4": ["97.51.17.173"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "de89370400440532013000"],
    "date": ["2024-02-29", "31.12.1999", "02/28/2001", "31/12/1985", "12-31-1985", "05-06-1999"],
    "email": ["Jane.Doe99@mail.example.com", "x" * 100 + "@example.com", "ünal.Öz@exämple.de", "ольга7@пример.рф"],
    "secret": ["04dbebab91ab85687d33eeaaf9ac699e1188f962"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_format_validity_and_inverse(kind, value):
    if kind == "card" and P.luhn_digit(re.sub(r"\D", "", value)[:-1]) != int(value[-1]):
        pytest.skip("not a valid number")
    new = NAMES.one(kind, value)
    assert new and new != value and NAMES.one(kind, value) == new
    assert P.Pseudonyms(b"k", back=True).one(kind, new) == value
    assert P.Pseudonyms(b"other").one(kind, value) != new
    if kind != "ipv4":
        value, new = ("".join("a" if c.isalpha() else c for c in x) if kind == "email" else x for x in (value, new))
        shape = lambda s: re.sub(r"[A-Za-z]" if kind != "secret" else r"[0-9a-f]", "a", re.sub(r"\d", "9", s) if kind != "secret" else s)
        assert shape(new) == shape(value)
    else:
        ipaddress.ip_address(new)
    assert kind == "email" or NAMES.one(kind, new) is not None  # still valid


def test_invalid_values_stay():
    text = "card 4111111111111112, ip 300.1.1.1, ssn 000-12-3456, date 2023-02-30, iban DE00370400440532013000, version 3.0, 1234567890123456789012"
    assert P.rewrite(text, NAMES) == (text, 0)


def test_equal_values_stay_linked():
    a, n = P.rewrite("from 97.51.17.173 to 97.51.17.173, x@y.example.com.", NAMES)
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", a)
    assert n == 3 and ips[0] == ips[1] != "97.51.17.173" and a.endswith("@y.example.com.")


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab@.-+ ()0123456789\n", max_size=80))
def test_texts_come_back(text):
    new, _ = P.rewrite(text, NAMES)
    assert len([m for m in P.find(text)]) >= 0
    back, _ = P.rewrite(new, P.Pseudonyms(b"k", back=True))
    if [k for _, _, k in P.find(new)] == [k for _, _, k in P.find(text)]:
        assert back == text


def test_edge_rows(spark):
    long = "word " * 200000 + "97.51.17.173"
    rows = [(1, None), (2, ""), (3, long), (4, "a"), (4, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 as n_pseudonyms", "'z' as c0")
    out = {r.doc_id: r for r in P.pseudonymise(docs).collect()}
    assert out[1].text is None and out[2].text == "" and out[4].text == "a" and out[4].c0 == "z"
    assert out[3].n_pseudonyms == 1 and len(out[3].text) > 1000000 - 10 and "97.51.17.173" not in out[3].text
    assert P.pseudonymise(docs.limit(0)).count() == 0


def test_whole_table_inverts(sf):
    docs = sf("documents")
    once = P.pseudonymise(docs)
    assert P.pseudonymise(once, back=True).drop("n_pseudonyms").exceptAll(docs).count() == 0
    left = {m for r in docs.select("text").collect() for m in re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", r.text)}
    assert left and not left & {m for r in once.select("text").collect() for m in re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", r.text)}


@pytest.mark.parametrize(
    "text,hidden",
    [
        ("4111 1111 1111 1111 123", "4111 1111 1111 1111"),
        ("4111111111111111 12/25", "4111111111111111"),
        ("qty 3 4111111111111111", "4111111111111111"),
        ("AB12 4111 1111 1111 1111", "4111 1111 1111 1111"),
        ("12 555-123-4567 1", "555-123-4567"),
        ("call +44 20 7946 0958 now", "20 7946 0958"),
        ("call +49 30 12345678.", "30 12345678"),
        ("+4930123456", "30123456"),
    ],
)
def test_numbers_beside_other_digits_are_hidden(text, hidden):
    new, n = P.rewrite(text, NAMES)
    assert n == 1 and hidden not in new and len(new) == len(text)
    at = text.index(hidden)
    assert new[:at] == text[:at] and new[at + len(hidden) :] == text[at + len(hidden) :]
    assert P.rewrite(new, P.Pseudonyms(b"k", back=True)) == (text, 1)


def test_long_runs_of_digits_take_linear_time():
    assert P.rewrite("1 " * 50000, NAMES)[1] == 0


def test_keys_of_any_length_differ():
    a, b = (P.Pseudonyms(b"k" * 64 + x).one("card", "4111111111111111") for x in (b"1", b"2"))
    assert a != b


@pytest.mark.parametrize("layout", ["%m/%d/%Y", "%d/%m/%Y", "%d-%m-%Y", "%m-%d-%Y"])
def test_dates_of_either_order_come_back(layout):
    import datetime as dt

    back = P.Pseudonyms(b"k", back=True)
    days = [dt.date(1999, 1, 1) + dt.timedelta(k) for k in range(366)]
    new = [NAMES.one("date", d.strftime(layout)) for d in days]
    assert len(set(new)) == len(new) and [back.one("date", x) for x in new] == [d.strftime(layout) for d in days]


PLANTED = {
    "card": ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
    "phone": ["(555) 123-4567", "555-123-4567", "+1 555 123 4567"],
    "e164": ["+44 20 7946 0958", "+49 30 12345678"],
    "ipv4": ["10.20.30.40", "255.255.255.255"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "gb82west12345698765432"],
    "date": ["2024-02-29", "31/12/1985", "12/31/1985", "12-31-1985", "31.12.1999", "1999/01/02"],
    "email": ["jane.doe@mail.example.com", "y" * 90 + "@example.org", "ünal@exämple.de"],
    "secret": ["token=04dbebab91ab85687d33eeaaf9ac699e"],
}
AROUND = [("", ""), ("see ", "."), ("(", ")"), ("x, ", ", and more"), ("é ", "\n"), ("on 3 May ", " 99 times")]


@pytest.mark.parametrize("kind", PLANTED)
def test_planted_values_are_replaced_and_nothing_else_is(kind):
    """Where each value stands is known beforehand: what is around it must stay, and it must not."""
    for value in PLANTED[kind]:
        for before, after in AROUND[: 5 if kind == "e164" else None]:  # a number in free groups may go on
            text = before + value + after
            got, n = P.rewrite(text, NAMES)
            assert n == 1 and got.startswith(before) and got.endswith(after) and len(got) >= len(before) + len(after), (text, got)
            inner = got[len(before) : len(got) - len(after)]
            assert inner != value and value.split("@")[0].removeprefix("token=") not in got, (text, got)
            assert P.rewrite(got, P.Pseudonyms(b"k", back=True))[0] == text


def plain_cards(text):
    """Spans of valid cards that start and end with digit groups, longest valid in a usual layout first; tried one by one."""
    groups = [m.span() for m in re.finditer("[0-9]+", text)]
    found = []
    for i in range(len(groups)):
        for j in range(i, len(groups)):
            a, b = groups[i][0], groups[j][1]
            digits = re.sub("[^0-9]", "", text[a:b])
            joined = all(text[groups[k][1] : groups[k + 1][0]] in (" ", "-") for k in range(i, j))
            total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))
            if joined and 13 <= len(digits) <= 19 and total % 10 == 0 and len(set(digits)) > 1:
                usual = [y - x for x, y in groups[i : j + 1]] in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4], [4, 4, 4, 4, 3]) or i == j
                found.append((not usual, -len(digits), a, b))
    kept = []
    for _, _, a, b in sorted(found):
        if all(b <= x or a >= y for x, y in kept):
            kept.append((a, b))
    return sorted(kept)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111", "1111", "4111111111111111", "3782", "822463", "10005", "99", "7", "5500", "0000", "0004"]), min_size=1, max_size=8), st.lists(st.sampled_from([" ", "-", ", "]), min_size=7, max_size=7))
def test_cards_against_trying_all_runs(parts, seps):
    text = "n " + "".join(x + y for x, y in zip(parts, [*seps, ""])).rstrip(" ,-")
    got = [(a, b) for a, b, k in P._numbers(text) if k == "card"]
    assert got == plain_cards(text)
