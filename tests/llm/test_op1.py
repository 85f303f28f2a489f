"""Pseudonyms: validity, linkage, round trip, edge cases."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from lapforge.llm import op1

CASES = [
    "mail jo.hn45@example.com now",
    "card 4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111112",
    "+1 (726) 555-7857 and (726) 555-7857",
    "ip 20.118.157.107 not 300.1.1.1",
    "born 1984-02-29, 29.02.1984, 12/31/2001, never 1983-02-29",
    "ssn 123-45-6789 not 000-12-3456",
    "iban DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 not DE88370400440532013000",
    "+49 30 1234567",
    "a@b.cd " + "abcdefghijklmnopqrstuvwxyz" * 2 + "0123456789" + "@example.org",
    "",
    None,
    "nothing here",
    "long " * 20000 + "4111111111111111",
]


@pytest.fixture(scope="module")
def pairs(spark):
    rows = spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(CASES)], "doc_id long, text string, v string, n_ip int")
    done = op1.pseudonymise(rows, "k1")
    assert done.columns == ["doc_id", "text", "v", *[f"n_{k}" for k in op1.KINDS]]
    assert "Python" not in done._jdf.queryExecution().executedPlan().toString()
    back = {r.doc_id: r.text for r in op1.restore(done.select("doc_id", "text"), "k1").collect()}
    return {r.doc_id: r for r in done.collect()}, back


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_round_trip(pairs):
    assert pairs[1] == dict(enumerate(CASES))


def test_cards_stay_valid_and_linked(pairs):
    a, b, kept = re.findall(r"\d[\d -]{14,18}\d", pairs[0][1].text.replace(" and", ","))
    assert a.replace(" ", "") == b.replace("-", "") != "4111111111111111" and luhn(a.replace(" ", ""))
    assert kept == "4111111111111112" and pairs[0][1].n_card == 2
    assert pairs[0][12].text == "long " * 20000 + a.replace(" ", "")


def test_phones_link_whatever_their_notation(pairs):
    a, b = re.findall(r"\((\d{3})\) (\d{3})-(\d{4})", pairs[0][2].text)
    assert a == b and a != ("726", "555", "7857") and a[0] >= "200" and a[1] >= "200"
    assert pairs[0][7].text.startswith("+49 ") and pairs[0][7].text != CASES[7] and len(pairs[0][7].text) == len(CASES[7])


def test_other_kinds_stay_valid(pairs):
    text = {i: r.text for i, r in pairs[0].items()}
    assert all(int(x) < 256 for x in re.search(r"ip (\S+) not 300", text[3])[1].split("."))
    iso, dotted, slashed = re.search(r"born (\S+), (\S+), (\S+), never 1983-02-29", text[4]).groups()
    assert datetime.date.fromisoformat(iso) == datetime.datetime.strptime(dotted, "%d.%m.%Y").date()
    assert datetime.datetime.strptime(slashed, "%m/%d/%Y").year in range(2001, 2101) and pairs[0][4].n_date == 3
    area, group, serial = re.search(r"ssn (\d{3})-(\d\d)-(\d{4}) not 000", text[5]).groups()
    assert 0 < int(area) < 900 and area != "666" and int(group) and int(serial)
    for iban in re.findall(r"\b(?:DE|GB)[\dA-Z ]+?(?= GB| not)", text[6]):
        s = iban.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    assert text[6].endswith("not DE88370400440532013000") and text[0].endswith("@example.com now")


def test_rest_is_untouched(pairs):
    assert [pairs[0][i].text for i in (9, 10, 11)] == ["", None, "nothing here"]
    assert all(pairs[0][i][f"n_{k}"] == 0 for i in (9, 10, 11) for k in op1.KINDS)


def test_permutations_are_bijective(spark):
    """Every two-digit number and every pair of letters is hit once."""
    f = op1.Feistel("k2")
    numbers = spark.range(100).select(F.expr(f.number("lpad(id, 2, '0')", "'t'")).alias("x"))
    assert sorted(r.x for r in numbers.collect()) == [f"{i:02d}" for i in range(100)]
    letters = spark.range(676).select(F.expr(f.word("concat(char(97 + id div 26), char(97 + id % 26))", "'t'")).alias("x"))
    assert letters.distinct().count() == 676
    days = spark.range(36525).select(F.expr(f.mixed("id", 75, 487, "'t'")).alias("x"))
    assert days.distinct().count() == 36525 and days.agg(F.max("x")).first()[0] == 36524


def test_keys_differ_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "4111111111111111")], "doc_id long, text string")
    assert op1.pseudonymise(rows, "a").first().text != op1.pseudonymise(rows, "b").first().text
    assert op1.pseudonymise(rows.limit(0), "a").count() == 0


def test_cards_and_ibans_next_to_others(spark):
    card, ibans = "4111 1111 1111 1111", ["AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "DE89370400440532013000"]
    around = ["{} 123", "{} 12/27", "12 {}", "{}-1234", *["{} " + str(i) for i in range(100, 160) if not luhn(card.replace(" ", "") + str(i))]]
    texts = [a.format(card) for a in around] + [i + tail for i in ibans for tail in (" BIC", " 500 EUR", " GB82 WEST 1234 5698 7654 32")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = op1.pseudonymise(rows, "k1").cache()
    for r in done.collect():
        n = 1 + ("GB82" in texts[r.doc_id])
        assert (r.n_card, r.n_iban) == ((1, 0) if r.doc_id < len(around) else (0, n)), r
        assert card not in r.text and not any(i in r.text for i in ibans)
        if r.doc_id < len(around):
            before, after = around[r.doc_id].split("{}")
            assert r.text.startswith(before) and r.text.endswith(after)
            assert len(r.text) == len(texts[r.doc_id])
    assert {r.doc_id: r.text for r in op1.restore(done.select("doc_id", "text"), "k1").collect()} == dict(enumerate(texts))


NOTATIONS = {
    "441632960961": ["+441632960961", "+44 1632 960961", "+44-1632-960961", "+44 (1632) 960961", "+44.1632.960.961"],
    "4930123456": ["+4930123456", "+49 30 123456", "+49 (30) 12 34 56"],
    "353861234567": ["+353861234567", "+353 86 123 4567", "+353-86-1234567"],
    "79161234567": ["+79161234567", "+7 916 123 45 67", "+7 (916) 123-45-67"],
    "12125550147": ["+12125550147", "+1 212 555 0147", "+1 (212) 555-0147", "+1.212.555.0147"],
}


def test_telephone_numbers_of_any_country_link(spark):
    texts = [(number, text) for number, all_ in NOTATIONS.items() for text in all_]
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    done = op1.pseudonymise(rows, "k1")
    got = {r.doc_id: r for r in done.collect()}
    for number, all_ in NOTATIONS.items():
        new = {re.sub(r"[^0-9]", "", got[i].text) for i, (n, _) in enumerate(texts) if n == number}
        code = {"44": 2, "49": 2, "35": 3, "79": 1, "12": 1}[number[:2]]
        assert len(new) == 1 and number not in new and new.pop()[:code] == number[:code], number
    assert all(re.sub(r"[0-9]", "0", got[i].text) == re.sub(r"[0-9]", "0", t) and got[i].n_phone == 1 for i, (_, t) in enumerate(texts))
    assert {r.doc_id: r.text for r in op1.restore(done.select("doc_id", "text"), "k1").collect()} == {i: t for i, (_, t) in enumerate(texts)}
    assert op1.pseudonymise(spark.createDataFrame([(1, "call 5552349876")], "doc_id long, text string"), "k").first().text == "call 5552349876"


def test_the_key_is_not_in_the_plan(spark):
    rows = spark.createDataFrame([(1, "4111111111111111")], "doc_id long, text string")
    done = op1.pseudonymise(rows, "a very secret key")
    assert "very secret" not in done._jdf.queryExecution().toString() and "very secret" not in repr(op1.Feistel("a very secret key"))


def test_the_end_of_a_walk_is_valid(spark, monkeypatch):
    monkeypatch.setattr(op1, "WALK", 1)
    texts = [f"4111 1111 1111 1111 {i}" for i in range(100, 160) if not luhn(f"4111111111111111{i}")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op1.pseudonymise(rows, "k1").collect():
        digits = r.text.replace(" ", "")
        assert r.n_card == 1 and luhn(digits[:16]) and digits[16:] == texts[r.doc_id][-3:] and digits[:16] != "4111111111111111"
