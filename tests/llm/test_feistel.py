from __future__ import annotations

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F
from support import SF, docs, table

from ordermill.llm import feistel
from ordermill.llm.queries import QUERIES


def rewritten(spark, *texts, key="k"):
    return [tuple(r) for r in feistel.pseudonymise(docs(spark, *texts), key).orderBy("doc_id").select("text", "kinds").collect()]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def shape(text):
    return re.sub(r"\d", "9", text)


def test_forms_are_kept_and_values_stay_linked(spark):
    values = {
        "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"],
        "phone": ["+1 (743) 555-3824", "+49 30 1234567", "(212) 555-0100", "212-555-0100"],
        "ip": ["192.168.10.255", "8.8.8.8"],
        "ssn": ["219-09-9999"],
        "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"],
        "date": ["2024-02-29", "31.12.1999", "02/03/1985", "12/25/2001"],
        "secret": ["b44e15e09fd311c3cf3163b66d5a9875b883d8ce"],
        "email": ["jane.doe+x@mail.example.com"],
    }
    for kind, forms in values.items():
        for value in forms:
            (first, kinds), (second, _) = rewritten(spark, f"See {value}, ok.", f"{value}")
            assert kinds == [kind], (value, kinds)
            new = first[4:-5]
            assert new == second and new != value and first == f"See {new}, ok."
            if kind not in ("email", "secret", "ip"):
                assert shape(new) == shape(value) if kind != "iban" else len(new) == len(value)
            if kind == "card":
                assert luhn(re.sub(r"\D", "", new))
            if kind == "ip":
                assert all(int(x) < 256 for x in new.split("."))
            if kind == "iban":
                plain = new.replace(" ", "")
                assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert rewritten(spark, "4111111111111111", key="a") != rewritten(spark, "4111111111111111", key="b")


def test_invalid_values_are_left(spark):
    for text in ("4111111111111112", "1999-02-30", "99/99/2020", "DE00370400440532013000", "300.1.2.3", "000-12-3456", "v1.2", "12345", "a@b", "2024"):
        assert rewritten(spark, text) == [(text, [])], text


def test_permutations_are_one_to_one_and_invert(spark):
    frame = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    moved = frame.select("d", feistel.permuted_digits(F.col("d"), F.lit("k"), "x").alias("p"))
    back = moved.select("d", "p", feistel.restore_digits(F.col("p"), F.lit("k"), "x").alias("b"))
    row = back.agg(F.countDistinct("p"), F.sum((F.col("b") == F.col("d")).cast("int")), F.max(F.length("p"))).first()
    assert tuple(row) == (10_000, 10_000, 4)
    days = spark.sql("select explode(sequence(date'1900-01-01', date'1999-12-31', interval 1 day)) as d")
    made = days.select(feistel._date(F.col("d").cast("string"), F.lit("k")).alias("p"))
    assert tuple(made.agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()) == (36524, "1900-01-01", "1999-12-31")
    areas = spark.range(1, 900).where("id <> 666").select(F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-01-0001")).alias("s"))
    ssn = areas.select(feistel._ssn(F.col("s"), F.lit("k")).alias("p")).collect()
    assert len({r.p for r in ssn}) == 898 and all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", r.p) for r in ssn)


def test_edge_cases(spark):
    assert rewritten(spark, None, "", "no data", "+1 (743) 555-3824 4111111111111111 4111111111111111")[:3] == [(None, []), ("", []), ("no data", [])]
    text, kinds = rewritten(spark, "a@b.com,c@d.org;+1 (743) 555-3824 4111111111111111 1.2.3.4")[0]
    assert kinds == ["email", "email", "phone", "card", "ip"] and not re.search("a@b|c@d|4111111111111111", text)
    long = "x" * 300_000 + " 4111111111111111 " + "a.b" * 100_000
    text, kinds = rewritten(spark, long)[0]
    assert kinds == ["card"] and len(text) == len(long)
    frame = docs(spark, "1.2.3.4", "1.2.3.4", ids=[None, None]).selectExpr("*", "1 as kind", "2 as old")
    rows = feistel.pseudonymise(frame, "k").collect()
    assert rows[0] == rows[1] and rows[0].kind == 1
    assert feistel.pseudonymise(docs(spark), "k").collect() == []


def test_key_is_required(spark):
    for call in (lambda: feistel.pseudonymise(docs(spark, "x")), lambda: feistel.pseudonymise(docs(spark, "x"), "")):
        with pytest.raises((TypeError, ValueError)):
            call()


class Plain:
    """The keyed permutation once more, in plain Python."""

    def __init__(self, key, kind):
        self.key, self.kind = key, kind

    def draw(self, size, turn, half):
        return int(hashlib.sha256(f"{self.key}|{self.kind}|{size}|{turn}|{half}".encode()).hexdigest()[:15], 16)

    def moved(self, value, left, right):
        l, r = divmod(value, right)
        for turn in range(feistel.ROUNDS):
            if turn % 2 == 0:
                l = (l + self.draw(f"{left}x{right}", turn, r)) % left
            else:
                r = (r + self.draw(f"{left}x{right}", turn, l)) % right
        return l * right + r

    def digits(self, text):
        n = len(text)
        return str(self.moved(int(text), 10 ** (n // 2), 10 ** (n - n // 2))).zfill(n)


def refill(form, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in form)


def test_against_a_plain_permutation(spark):
    phone = Plain("k", "phone")
    for text, code in {
        "+353 86 123 4567": 3, "+353 1 234 5678": 3, "+7 912 345 6789": 1, "+44 20 7946 0958": 2, "+1 (743) 555-3824": 1,
        "+420 601 123 456": 3, "(212) 555-0100": 0,
    }.items():
        digits = re.sub(r"\D", "", text)
        assert rewritten(spark, text) == [(refill(text, digits[:code] + phone.digits(digits[code:])), ["phone"])]
    card = "4111 1111 1111 1111"
    body = Plain("k", "card").digits(card.replace(" ", "")[:-1])
    check = next(c for c in "0123456789" if luhn(body + c))
    assert rewritten(spark, card) == [(refill(card, body + check), ["card"])]
    first = datetime.date(2000, 1, 1)
    day = datetime.date(2024, 2, 29)
    moved = first + datetime.timedelta(days=Plain("k", "date").moved((day - first).days, 75, 487))
    assert rewritten(spark, day.isoformat(), "29.02.2024") == [
        (moved.isoformat(), ["date"]), (moved.strftime("%d.%m.%Y"), ["date"]),
    ]
    ip = Plain("k", "ip").moved(int.from_bytes(bytes([192, 168, 10, 255])), 65536, 65536)
    assert rewritten(spark, "192.168.10.255") == [(".".join(map(str, ip.to_bytes(4))), ["ip"])]


def test_query_leaves_nothing_behind(spark):
    before = dict(table(spark, "documents").select("doc_id", "text").collect())
    pattern = re.compile(r"[\w.%+-]+@[\w.-]+\.[a-zA-Z]{2,}|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)")
    changed = 0
    for r in QUERIES["op7_feistel_pseudonyms"](spark, SF).collect():
        old = pattern.findall(before[r.doc_id])
        cards = [c for c in re.findall(r"(?<!\w)\d{16}(?!\w)", before[r.doc_id]) if luhn(c)]
        assert not [x for x in old + cards if x in r.text]
        assert (r.text == before[r.doc_id]) == (r.n_replaced == 0)
        changed += r.n_replaced > 0
    assert changed > 5
