"""Lemmas by detachment rules and sentence matching, on hand-made rows."""

import random

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from fieldtide.functions import fixed_values as fixed
from fieldtide.functions import text as tx
from fieldtide.operators import reviews as rv
from fieldtide.operators import text as tt


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(1, "glass glasses  wolves\tbuses series churches men women houses"), (2, "house lives boxes berries this was classes\nbus"),
            (3, None), (4, ""), (5, "  "), (6, "glasses, dogs")]
    return spark.createDataFrame(rows, "id int, text string")


def test_lemmas_of_known_words(texts):
    got = {r.id: r.lemmatized for r in tt.lemmatize(texts, "text").collect()}
    assert got[1] == "glass glass wolf bus series church man woman house"
    assert got[2] == "house life box berry this was class bus"
    assert (got[3], got[4], got[5], got[6]) == (None, "", "", "glasses, dog")


def test_a_vocabulary_decides_between_endings(spark):
    df = spark.createDataFrame([(1, "axles knaves stoves")], "id int, text string")
    words = spark.createDataFrame([("stove",), ("knave",)], "form string")
    assert tt.lemmatize(df, "text", vocabulary=words).first().lemmatized == "axle knave stove"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_table_of_any_size(spark, texts, limit, monkeypatch):
    monkeypatch.setattr(tt, "SMALL_TABLE", limit)
    table = spark.createDataFrame([("glasses", "glass"), ("glasses", "zz"), ("this", "that"), ("bus", None)], "form string, lemma string")
    got = {r.id: r.lemmatized for r in tt.lemmatize(texts, "text", table, key="id").collect()}
    assert got == {1: "glass glass wolves buses series churches men women houses", 2: "house lives boxes berries that was classes bus",
                   3: None, 4: "", 5: "", 6: "glasses, dogs"}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_sentence(query, raw):
    best, at = 0.0, 0
    for i, sentence in enumerate(raw):
        words = sentence.split()
        n = min(len(query.split()), len(words))
        for j in range(len(words) - n + 1 if n else 0):
            run = " ".join(words[j:j + n])
            score = 1.0 - edits(run, query) / max(len(run), len(query))
            if score > best:
                best, at = score, i
    return raw[at] if raw else None


def test_matched_sentences_against_plain_loops(spark):
    rng = random.Random(4)
    words = ["ab", "abc", "bcd", "dog", "dig", "cat", "a"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(0, 6)))
    rows = [([text() for _ in range(rng.randrange(0, 4))], [text() for _ in range(rng.randrange(0, 5))]) for _ in range(150)]
    df = spark.createDataFrame([*rows, (["x"], None), (None, ["x"])], "q array<string>, raw array<string>")
    for row in df.select("q", "raw", rv.match_sentences(F.col("q"), F.col("raw")).alias("got")).collect():
        want = None if row.q is None or row.raw is None else [best_sentence(q, row.raw) for q in row.q]
        assert row.got == want, row


SENTENCES = [
    ("We met Dr. Smith. He was late.", ["We met Dr. Smith.", "He was late."]),
    ("Parts, e.g. 5 bolts. Then J. R. Jones came! Why?  So.", ["Parts, e.g. 5 bolts.", "Then J. R. Jones came!", "Why?", "So."]),
    ("On the 3. floor. In 1999. Then", ["On the 3. floor.", "In 1999.", "Then"]),
    ("(vs. them) and \"St. Mary\". end.\nNext", ["(vs. them) and \"St. Mary\".", "end.", "Next"]),
    ("", []), (None, None), ("no end", ["no end"]),
]


def test_abbreviations_initials_and_ordinals_end_no_sentence(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SENTENCES)], "id int, text string")
    listed = spark.createDataFrame([(a,) for a in fixed.ABBREVIATIONS], "form string")
    both = tt.learnt_sentences(df, "text", listed, "learnt").select("id", "learnt", tx.split_sentences(F.col("text")).alias("native"))
    for row in both.collect():
        want = SENTENCES[row.id][1]
        assert row.native == want and row.learnt == want, row


def test_abbreviations_are_learnt_from_the_texts(spark):
    rows = [(i, f"The abt. value of no. {i} is high. A high value is now no value. See tel. {i} now.") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.form for r in tt.learn_abbreviations(df, "text").collect()}
    assert {"abt", "tel"} <= got and not {"value", "high", "no", "now"} & got
    found = tt.learnt_sentences(df, "text", tt.learn_abbreviations(df, "text")).first().sentences
    assert found[-1].startswith("See tel. ")


def test_a_batch_of_texts_is_looked_up_in_small_pieces():
    texts = pa.array(["a b " * 50, None, "", *["word " * 200] * 40])
    parts = list(tt.pieces(texts, 4096))
    assert pa.concat_arrays(parts).equals(texts)
    assert len(parts) > 5 and max(p.nbytes for p in parts) < 3 * 4096
    assert [len(p) for p in tt.pieces(texts.slice(0, 0))] == [0]
