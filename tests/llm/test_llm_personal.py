"""Personal data: spans against plain loops over the patterns, checksums, context, odd rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fieldtide.llm import pii, queries

BASE = [("email", queries.PII_PATTERNS["email"]), ("ip", queries.PII_PATTERNS["ip"]), ("card", queries.PII_PATTERNS["card"]),
        ("phone", queries.PII_PATTERNS["phone"])]


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    """The four base kinds by plain loops."""
    found = []
    for place, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), place, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(found)]


TEXTS = [
    "a@b.c_d@e.f, x@y no@dot. é üser.name+tag%1@mail-1.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.0003.255 1.2.3",
    "4929 3483-8514 6306 4929348385146306 4929348385146307 1-2 3", "+1 (017) 555-7713 +12 +1() 2 +49.30.1234567-89)",
    "é😀 a@b.de 😀 10.0.0.1 +441234567890", "4111 1111 1111 1111.2.3.4 a@1.2.3.4", "\n\t", "", None,
    "9" * 3_000 + " " + "a" * 3_000 + "@" + "1." * 500 + "a@b.co\n" * 300 + "+" + "1" * 200,
]
SCHEMA = "doc_id long, text string, spans string, score double, start int, kind string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, "kept", 0.5, 1, "x") for i, t in enumerate(TEXTS)], SCHEMA)


def test_base_spans_are_those_of_plain_loops(rows):
    for row in pii.find_personal_data(rows, out="found").collect():
        got = [(s.kind, s.start, s.end) for s in row.found if s.kind in dict(BASE)]
        assert got == base_spans(row.text), row.doc_id
        assert all(row.text[s.start:s.end] == s.value for s in row.found)
        assert (row.spans, row.score, row.start, row.kind) == ("kept", 0.5, 1, "x")


def test_odd_rows(spark, rows):
    doubled = pii.find_personal_data(rows.union(rows)).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()
    assert len(doubled) == 2 * len(TEXTS) and len({tuple(r) for r in doubled}) == len(TEXTS)
    assert pii.find_personal_data(rows.where("false")).count() == 0
    assert {r.s for r in doubled if not TEXTS[r.doc_id]} == {""}


def kinds_of(spark, text):
    row = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    return [(s.kind, s.value, s.score) for s in row.spans]


def test_checksums_and_context(spark):
    text = ("Bank DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432, DE89 3704 0044 0532 0130 01. My SSN is 123-45-6789, not 000-45-6789; "
            "part 223-45-6789. Born on 31.12.1980 and "
            "born 32.12.1980. The whole of the sum that was due had been paid by 3.4.2001 in full.")
    got = kinds_of(spark, text)
    assert [(k, v) for k, v, _ in got if k in ("iban", "ssn", "birth")] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"), ("ssn", "123-45-6789"), ("birth", "31.12.1980")]
    assert [s for k, _, s in got if k == "iban"][0] == 1.0


def test_context_moves_the_score_of_base_spans_but_keeps_them(spark):
    assert kinds_of(spark, "host 10.1.2.3") == [("ip", "10.1.2.3", 0.8)]
    assert kinds_of(spark, "version 10.1.2.3") == [("ip", "10.1.2.3", 0.2)]
    assert kinds_of(spark, "go to 10.1.2.3") == [("ip", "10.1.2.3", 0.5)]


def test_running_sums(spark):
    for n in (0, 1, pii.BLOCK, pii.BLOCK + 1, 1_000):
        got = spark.range(1).select(pii.running(F.array(*[]).cast("array<int>") if n == 0 else F.sequence(F.lit(1), F.lit(n))).alias("r")).first().r
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_query_digest(spark, tmp_path):
    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in queries.QUERIES["op11_context_pii"](spark, str(tmp_path)).collect():
        want = base_spans(TEXTS[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in want) for kind, _ in BASE]
