"""Rules on hand-made rows: every branch, NULLs and edges."""

import pytest
from pyspark.sql import functions as F

from fieldtide.functions import dates, rules
from fieldtide.functions import fixed_values as fixed
from fieldtide.functions import text as tx


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("cancel, new, planned, follow, status", [
    ("2024-01-01", 1, 2, None, "Canceled"),
    (None, 2, 1, "2024-01-01", "Rescheduled"),
    (None, 1, 1, None, "Aged"),
    (None, None, 1, None, "Unscheduled"),
    (None, 1, 1, "2024-01-01", "Installed"),
    (None, 1, None, "2024-01-01", "Error"),
])
def test_job_status(spark, cancel, new, planned, follow, status):
    df = spark.createDataFrame([(cancel, new, planned, follow)], "c string, n int, p int, f string")
    got = df.select(rules.job_status(F.col("c"), F.col("n"), F.col("p"), F.col("f")).alias("s")).first()["s"]
    assert got == status


@pytest.mark.parametrize("text, reason", [
    ("Service appointment scheduled by TOA failed - x", "Service appointment scheduling failed"),
    ("an Installer appointment scheduled by TOA", "Installer appointment scheduled"),
    ("a Service appointment scheduled by TOA", "Service appointment scheduled"),
    ("x Unschedule Reason code -  Other by TOA", "Unschedule Reason code -  Other"),
    ("x Reschedule Reason code -  Other by TOA", "Reschedule Reason code -  Other"),
    ("x Unschedule Reason code -  Rain Scheduling Comments -  y by TOA", "Unschedule Reason code -  Rain "),
    ("x Reschedule Reason code -  Crew by TOA", "Reschedule Reason code -  Crew by TO"),
    ("Override Reason code -  Cap Scheduling Comments by TOA", "Override Reason code -  Cap "),
    ("Override Reason code -  Cap by TOA", "Override Reason code -  Cap by TO"),
    ("Measure appointment Re-scheduled by TOA", "No reason found"),
    ("odd text by TOA", "odd text by TOA"),
    ("a plain note", "No reason found"),
    (None, "No reason found"),
])
def test_reason_extract(spark, text, reason):
    assert one(spark, text, rules.reason_extract) == reason


def test_history_reason_goes_first(spark):
    df = spark.createDataFrame([("a by TOA", "Customer"), ("a by TOA", None)], "t string, h string")
    got = [r[0] for r in df.select(rules.reason_extract(F.col("t"), F.col("h"))).collect()]
    assert got == ["Customer", "a by TOA"]


@pytest.mark.parametrize("text, cleaned", [
    ("Email send to a@b.c report.pdf", ""),
    ("Installer Package 7 successfully added  to Lead#9", ""),
    ("x by TOA", ""),
    ("x by FSL Scheduling Comments -  call first", "call first"),
    ("Appointment for WO 1234567. moved", "moved"),
    ("Comments from APP Workflow: hello ", "hello"),
    ("Installer Bob X scheduled for 1/12/2024", ""),
    (None, ""),
])
def test_comment_clean(spark, text, cleaned):
    assert one(spark, text, rules.comment_clean) == cleaned


@pytest.mark.parametrize("text, expanded", [
    ("I DON'T know", "I do not know"),
    ("don't, stop", "don't, stop"),
    ("cant  won't\tY'ALL'RE", "cannot will not you all are"),
    ("the 4th", "the forth"),
    ("  nothing   here ", "nothing here"),
    ("scant dontxx", "scant dontxx"),
    ("", ""),
    (None, None),
])
def test_expand_contractions(spark, text, expanded):
    assert one(spark, text, tx.expand_contractions) == expanded


def test_contractions_are_expanded_alike_with_and_without_the_short_cut(spark):
    words = [w for w in fixed.CONTRACTIONS] + [w.upper() for w in fixed.CONTRACTIONS]
    df = spark.createDataFrame([(f"a {w} b",) for w in words], "v string")
    table = fixed.CONTRACTIONS
    got = [r[0] for r in df.select(tx.expand_contractions(F.col("v"))).collect()]
    assert got == [f"a {table[w.lower()]} b" for w in words]


@pytest.mark.parametrize("text, cleaned", [
    ("see https://ex.org/en/685 now", "see URLLINK/en/685 now"),
    ("café can’t", "caf cannot"),
    ("my Star Review side by side", "my    "),
    ("set up and put together", "setup and assemble"),
])
def test_clean_text(spark, text, cleaned):
    assert one(spark, text, tx.clean_text) == cleaned


@pytest.mark.parametrize("words, lemmas", [
    ("stories boxes classes wolves firemen cars", "story box class wolf fireman car"),
    ("bus his is as grass dues men xes", "bus his is as grass due men xes"),
])
def test_noun_lemmas(spark, words, lemmas):
    assert one(spark, words, tx.noun_lemmas) == lemmas


@pytest.mark.parametrize("day, week, key", [
    ("2021-02-01", 1, "202101"), ("2021-01-31", 52, "202052"), ("2020-02-03", 1, "202001"),
    ("2022-01-31", 1, "202201"), ("2019-02-03", 53, "201853"), ("2021-02-08", 2, "202102"),
])
def test_fiscal_week(spark, day, week, key):
    row = spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d")).select(
        dates.fiscal_week(F.col("d")).alias("w"), dates.fiscal_week_key(F.col("d")).alias("k")).first()
    assert (row.w, row.k) == (week, key)


def test_fiscal_week_from_a_given_start(spark):
    got = one(spark, "2021-02-15", lambda c: dates.fiscal_week(c.cast("date"), "2021-02-01"))
    assert got == 3


def test_datetime_diff_counts_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 01:01:00' a, timestamp_ntz'2024-01-01 00:59:59' b")
    got = df.select(dates.fn_datetime_diff("hour", F.col("a"), F.col("b")), dates.fn_datetime_diff("minute", F.col("b"), F.col("a")))
    assert tuple(got.first()) == (1, -2)


def test_store_rank(spark):
    df = spark.createDataFrame([(0.0,), (1.9,), (2.0,), (None,)], "w double")
    assert [r[0] for r in df.select(rules.store_rank(F.col("w"))).collect()] == [1, 2, 3, 3]


def test_lookup_replace_keeps_unknown_values(spark):
    df = spark.createDataFrame([("027",), ("9",), (None,)], "d string")
    assert [r[0] for r in df.select(rules.lookup_replace(F.col("d"), {"027": "27"})).collect()] == ["27", "9", None]
