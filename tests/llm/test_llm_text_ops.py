"""Licences, recurring lines, quality rules, chats: brute force, round trips and odd rows."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtide.llm import chat, license_scan, line_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, shard string, n_lines int"


def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns that clash with new ones."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "a b c", "en", "s", 5, 1, "x", "y", 2), (1, "a b c", "en", "s", 5, 1, "x", "y", 2), (2, None, "en", None, None, None, None, None, None),
        (3, "", None, "s", 0, 1, "x", "y", 2), (None, "only text", None, None, 1, 1, "x", "y", 2), (4, long, "de", "s", 1, 1, "x", "y", 2),
        (5, " \t\n\x0b\x0c\r", "en", "s", 1, 1, "x", "y", 2), (6, "   é\n\n\nüß\nüß", "en", "s", 1, 1, "x", "y", 2),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("op", [
    license_scan.license_scan, line_dedup.drop_recurring_lines, quality_rules.quality_rules,
])
def test_odd_rows(spark, op):
    df = odd(spark)
    assert op(df).count() == 8
    assert op(df.where("false")).count() == 0


def test_licences_follow_ordered_rules(spark):
    rows = [
        (1, "Intro.\nLicensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License. "
            "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. End."),
        (2, "The MIT License. All rights reserved. x"), (3, "licensed UNDER cc by-nc 4.0!"), (4, "He got a license. It is under dispute."),
        (5, None), (6, "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3."),
    ]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licenses == "Apache-2.0" and got[1].sentence_ids == "apache-notice apache-comply apache-copy"
    assert got[2].licenses == "MIT proprietary" and got[2].category == "reserved"
    assert got[3].category == "noncommercial" and got[4].category == "none" and got[5].n_sentences == 0
    assert got[6].licenses == "MIT GPL-3.0" and got[6].category == "copyleft"


def brute_lines(rows, depth, least):
    """Recurring lines by plain loops, per distinct text; ``least`` is the number of texts by token count."""
    texts = sorted({t for _, t in rows if t is not None})
    lines = []
    for d, text in enumerate(texts):
        for i, line in enumerate(text.split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line))
            if tokens:
                lines.append((d, i, (len(tokens), tokens[:depth]), tokens))
    leaves = collections.defaultdict(set)
    size = collections.Counter(x[2] for x in lines)
    for _, _, leaf, tokens in lines:
        leaves[leaf].add(tokens)
    member, seen = {}, collections.defaultdict(set)
    for d, i, leaf, tokens in lines:
        if size[leaf] < least(leaf[0]):
            continue
        forms, own = leaves[leaf], tokens
        if len(forms) > 1:
            same = 0
            for p, token in enumerate(tokens):
                c, top = max((n, t) for t, n in collections.Counter(f[p] for f in forms).items())
                same += c >= line_dedup.CONSTANT * len(forms) and top == token
            if same >= line_dedup.SIMILAR * len(tokens):
                own = None
        member[d, i] = (leaf, own)
        seen[leaf, own].add(d)
    gone = {k for k, m in member.items() if len(seen[m]) >= least(m[0][0])}
    return {t: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in enumerate(texts)}


def test_long_lines_recur_sooner(spark):
    long = " ".join(f"passage{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    middle = " ".join(f"line{chr(97 + i)}" for i in range(25))
    rows = [(d, f"own text {chr(97 + d) * 3}\n" + (long + "\n" if d < 3 else "") + (middle + "\n" if d < 6 else "") + "short line") for d in range(11)]
    rows += [(100 + d, f"alone {chr(97 + d) * 4}\n" + middle.replace("line", "other")) for d in range(5)]
    got = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, text in rows:
        assert got[d] == "\n".join(x for x in text.split("\n") if x not in (long, middle)), d


def test_recurring_lines_against_brute_force(spark):
    draw = np.random.default_rng(3)
    vocabulary = [f"word{chr(97 + i)}" for i in range(20)]
    rows = []
    for d in range(60):
        lines = [" ".join(draw.choice(vocabulary, draw.integers(1, 9))) for _ in range(draw.integers(1, 5))]
        if d % 2:
            lines.append(f"user {draw.choice(['ann', 'bob', 'cyd', 'dan'])} logged in from host h{d} at noon today")
        if d % 3 == 0:
            lines.append("the same line in many documents")
        rows.append((d, "\n".join(lines)))
    rows += [(100, rows[0][1]), (101, None), (102, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_recurring_lines(df, min_docs=((6, 4), (0, 8))).collect()}
    want = brute_lines(rows, line_dedup.DEPTH, lambda n: 4 if n >= 6 else 8)
    for d, text in rows:
        assert got[d].text == (None if text is None else want[text])
    assert "logged in" not in got[1].text and "the same line" not in got[0].text and got[101].n_lines == 0


def brute_base(text):
    w = WORD.findall(text or "")
    three = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_columns_against_brute_force(spark):
    draw = np.random.default_rng(1)
    texts = [None, "", "a", "a b", "a b c a b c", "x x x x x", "# * $ |<>|", "l1\nl1\n\n \nl1 \nl2"]
    texts += [" ".join(draw.choice(list("abcd"), n)) for n in (3, 4, 7, 20, 200)] + ["é ü\n" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.base_columns(df).collect():
        n, chars, symbols, dup, rep = brute_base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), texts[r.doc_id]
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)


def brute_mcd(x, share, steps):
    floor = np.diag(np.array(quality_rules.FLOOR, float) ** 2)
    mean, cov = np.median(x, 0), 4 * floor
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        rank = np.floor(np.log1p(d) * 64)
        inner = x[rank <= np.quantile(rank, share)]
        mean = inner.mean(0)
        cov = (inner.T @ inner / len(inner) - np.outer(mean, mean)) * quality_rules.CONSISTENCY + floor
    return lambda y: np.einsum("ij,jk,ik->i", y - mean, np.linalg.inv(cov), y - mean)


def test_covariance_against_numpy(spark):
    draw = np.random.default_rng(2)
    x = np.round(draw.multivariate_normal([1800, 200, 50, 100], np.array([[9e3, 2e3, 0, 1e3], [2e3, 2e4, 0, 0], [0, 0, 1e3, 0], [1e3, 0, 0, 9e3]]), 600))
    x[:40] += [3000, 2000, 0, 0]
    df = spark.createDataFrame([("g", *map(int, r)) for r in x], "_fit string, _f0 long, _f1 long, _f2 long, _f3 long")
    est = quality_rules.estimates(df, ["_fit"])
    got = [r.d for r in df.join(est, "_fit").orderBy(*quality_rules.STATS).select(quality_rules._distance().alias("d")).collect()]
    order = np.lexsort(x.T[::-1])
    want = brute_mcd(x, quality_rules.SHARE, quality_rules.STEPS)(x[order])
    assert np.allclose(got, want, rtol=1e-6)
    far = np.isin(order, np.arange(40))
    assert np.array(got)[far].min() > 100 and np.median(np.array(got)[~far]) < 5


def test_outliers_go_and_clean_documents_stay(spark):
    draw = np.random.default_rng(4)
    vocabulary = ["".join(draw.choice(list("aeioulnrst"), draw.integers(2, 8))) for _ in range(400)]
    rows = [(i, " ".join(draw.choice(vocabulary, 120)), "en", "s") for i in range(300)]
    rows += [(1000 + i, "*** ".join(draw.choice(vocabulary, 120)), "en", "s") for i in range(10)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i].kept for i in range(10)) and all(got[i].kept for i in range(300))
    assert math.isfinite(got[0].distance)


@pytest.mark.parametrize("junk", [162, 245])
def test_outliers_of_over_a_third_of_a_group_go(spark, junk):
    draw = np.random.default_rng(5)
    vocabulary = ["".join(draw.choice(list("aeioulnrst"), draw.integers(2, 8))) for _ in range(400)]
    rows = [(i, " ".join(draw.choice(vocabulary, 120)), "en", "s") for i in range(300)]
    equal = "*** ".join(draw.choice(vocabulary, 120))
    rows += [(1000 + i, equal, "en", "s") for i in range(junk)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[1000 + i] for i in range(junk)) and all(got[i] for i in range(300))


CHATS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 2, "user", "b <|im_end|>"), (1, 3, "assistant", "c\\|"), (1, 4, "assistant", None),
    (2, 0, "assistant", "<|im_next|>\\\\<\\|x"), (2, 0, "assistant", "<"), (3, None, None, None), (3, 1, "ro\nle<|", "\\n"), (None, 0, "user", "x"),
    (4, 0, "user", ""), (5, 7, "user", "same"), (5, 7, "user", "same"), (6, 1, "assistant", "long " * 50_000),
]


def test_chats_round_trip(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat.parse_chats(chat.format_chats(df)).collect()}
    low = lambda v: (v is not None, v if v is not None else 0)
    for conv in {c[0] for c in CHATS}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in CHATS if c == conv), key=lambda t: (low(t[0]), chat_key(t[1]), t[2]))
        assert [tuple(t) for t in got[conv].turns] == [(r, x) for _, r, x in turns], conv
        assert list(got[conv].learned) == [x for _, r, x in turns if r == "assistant"]
        assert got[conv].formatted.count(chat.START) == len([1 for i, t in enumerate(turns) if i == 0 or turns[i - 1][1] != t[1]])


def chat_key(role):
    return role.replace("\\", "\\\\").replace("<|", "<\\|").replace("\n", "\\n")


def test_no_chats(spark):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.parse_chats(chat.format_chats(df)).count() == 0
