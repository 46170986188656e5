import re
from datetime import date

import pytest
from hypothesis import given, settings, strategies as st

from plinth.llm import pii, queries

P = pii.Pseudonymiser(b"k")


def card(body):
    return body + pii.luhn_digit(body)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=20), st.lists(st.integers(0, 9), min_size=1, max_size=20))
def test_feistel_keeps_values_apart(a, b):
    f = pii.Feistel(b"k")
    x, y = f.digits(a, 10, "t"), f.digits(b, 10, "t")
    assert len(x) == len(a) and all(0 <= d < 10 for d in x)
    assert (x == y) == (a == b)


def test_small_domains_are_permuted():
    f = pii.Feistel(b"k")
    assert sorted(f.below(i, 1000, "t") for i in range(1000)) == list(range(1000))
    assert sorted(tuple(f.digits([a, b, c], 7, "t")) for a in range(7) for b in range(7) for c in range(7)) == sorted((a, b, c) for a in range(7) for b in range(7) for c in range(7))


@pytest.mark.parametrize(
    ("raw", "kind"),
    [
        (card("453201511283036"), "card"),
        ("4532 0151 1283 0366", "card"),
        ("DE89 3704 0044 0532 0130 00", "iban"),
        ("GB82WEST12345698765432", "iban"),
        ("123-45-6789", "ssn"),
        ("+1 (017) 555-7713", "phone"),
        ("(212) 555-0187", "phone"),
        ("129.38.82.176", "ip"),
        ("2021-02-28", "date"),
        ("31/12/1999", "date"),
        ("12/31/1999", "date"),
        ("the.34@mail7.example.com", "email"),
        ("04dbebab91ab85687d33eeaaf9ac699e1188f962", "secret"),
        ("4f" * 90, "secret"),
        ("local" * 30 + ".x@" + ".".join("abcdefghijklm") + ".example.com", "email"),
        ("+49 30 1234567", "phone"),
        ("+4930 1234567", "phone"),
        ("212 555 0123", "phone"),
        ("2001:db8:0:1:1:1:1:1", "ip6"),
        ("1/2/2024", "date"),
        ("01/2/2024", "date"),
    ],
)
def test_kinds(raw, kind):
    text, kinds = P.replace(f"see {raw}, and {raw}###")
    new = re.match(r"see (.*), and (.*)###$", text)
    assert kinds == [kind, kind] and new[1] == new[2] != raw
    assert P.replace(f"see {new[1]} x")[1] == [kind]  # still valid
    if kind not in ("ip", "email", "ip6") and raw != "1/2/2024":
        assert re.sub(r"\w", "x", new[1]) == re.sub(r"\w", "x", raw)
    assert pii.Pseudonymiser(b"other").replace(raw)[0] != P.replace(raw)[0]


@pytest.mark.parametrize(
    ("raw", "kinds"),
    [
        ("+1 (017) 555-7713 129.38.82.176", ["phone", "ip"]),
        ("+44 20 7946 0958 2021 1234 99", ["phone"]),
        ("DE89 3704 0044 0532 0130 00 ABC", ["iban"]),
        ("4532015112830366 4532015112830366", ["card", "card"]),
        ("4532015112830366 123", ["card"]),
        ("a.b@c.example.com,4532015112830366,2020-01-01", ["email", "card", "date"]),
        ("2024 4111 1111 1111 1111 was", ["card"]),
        ("ID12 4111 1111 1111 1111", ["card"]),
        ("2020-02-01T10:00:00", ["date"]),
        ("a::b std::cafe 10:00:00 aa:bb:cc:dd:ee:ff", []),
    ],
)
def test_neighbours(raw, kinds):
    assert P.replace(f"x {raw} y")[1] == kinds


def test_notation_does_not_matter():
    a, b = P.replace("4532015112830366")[0], P.replace("4532-0151-1283-0366")[0]
    assert a == b.replace("-", "")


@pytest.mark.parametrize("raw", ["4532015112830367", "999.1.1.1", "2021-02-30", "000-12-3456", "DE89370400440532013001", "1234567", "1.2.3", "12345678901234567890123456789012", "version 10.2.3.4.5", "0123456789012345678901"])
def test_invalid_values_stay(raw):
    assert P.replace(f"a {raw} b") == (f"a {raw} b", [])


def test_formats_of_dates_are_permuted_one_to_one():
    by = {}
    for n in range(0, pii._DAYS, 61):
        d = pii._FIRST + pii.timedelta(n)
        for m, x in ((d.day, d.month), (d.month, d.day)):
            for raw in (f"{m:02d}/{x:02d}/{d.year}", f"{m}/{x}/{d.year}", f"{m:02d}/{x}/{d.year}", f"{m}.{x:02d}.{d.year}"):
                by.setdefault(pii._read_date(raw)[1], set()).add(raw)
        by.setdefault(("-", "ymd", "padded"), set()).add(d.isoformat())
    assert len(by) >= 9
    everything = [raw for form in by.values() for raw in form]
    for form, raws in by.items():
        new = {P._date(raw) for raw in raws}
        assert len(new) == len(raws) and {pii._read_date(x)[1] for x in new} == {form}
    assert len({P._date(raw) for raw in everything}) == len(everything)


def test_values_of_a_kind_stay_apart():
    phones = [f"+1 212 555 0{i:03d}" for i in range(300)] + [f"+49 30 12{i:05d}" for i in range(300)] + [f"(017) 555-0{i:03d}" for i in range(300)]
    assert len({P._phone(x) for x in phones}) == 900
    ssns = [f"{a:03d}-45-{b:04d}" for a in range(100, 120) for b in range(1, 40)]
    assert len({P._ssn(x) for x in ssns}) == len(ssns)
    secrets = [f"{i:030x}ab1" for i in range(500)]
    assert len({P._secret(x) for x in secrets}) == 500


def test_one_number_in_several_notations():
    new = [re.sub(r"\D", "", P.replace(x)[0])[-10:] for x in ("212 555 0123", "(212) 555-0123", "212-555-0123", "+1 212 555 0123", "+12125550123")]
    assert len(set(new)) == 1 and new[0] != "2125550123"


def test_key_is_of_the_session(spark):
    assert pii.session_key(spark) == pii.session_key(spark) and len(pii.session_key(spark)) == 32
    spark.conf.set(pii.SETTING, "given")
    assert pii.session_key(spark) == b"given"
    spark.conf.unset(pii.SETTING)
    with pytest.raises(ValueError, match="key"):
        pii.Pseudonymiser(b"")


def test_calendar():
    for day in ("1900-01-01", "2099-12-31", "2000-02-29"):
        assert date.fromisoformat(P.replace(day)[0])


def test_long_words_are_quick():
    assert P.replace("z1" * 400_000 + "@")[1] == []
    P.replace("1.2-" * 200_000)
    assert P.replace("9f" * 100_000 + " " + "a." * 100_000 + "b@c." + "d." * 100_000 + "com")[1] == ["secret", "email"]


def test_frames(spark, sf_dir):
    rows = [(1, None, "q"), (2, "", "q"), (2, "", "q"), (None, "mail a.b@c.example.com", "q"), (3, "no data", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_count string")
    got = pii.pseudonymise(df, b"k").collect()
    assert sorted(got[0].asDict()) == ["doc_id", "pii_count", "pii_count_", "pii_kinds", "text"] and {r.pii_count for r in got} == {"q"}
    assert [(r.text, r.pii_count_) for r in got][:3] == [(None, 0), ("", 0), ("", 0)] and got[3].pii_kinds == "email" and got[4].text == "no data"
    assert pii.pseudonymise(df.limit(0), b"k").count() == 0
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    p = pii.Pseudonymiser(pii.session_key(spark))
    for r in queries.op2_pii(spark, sf_dir).collect():
        assert (r.text, r.pii_count) == ((x := p.replace(source[r.doc_id]))[0], len(x[1]))
