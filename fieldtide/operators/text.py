"""Text steps that need more than one row or a lookup table."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import fixed_values as fixed
from fieldtide.functions import text as tx
from fieldtide.session import stored

SMALL_TABLE = 32 << 20  # characters of a lemma table that is sent to every task
PIECE = 1 << 20  # bytes of text that a lookup turns into Python strings at a time
SALTS = 32  # parts of the tokens of one word in the join with a larger table


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[pa.Array]:
    """The texts of an Arrow batch in turn, in slices of about ``size`` bytes: only a slice need be Python strings at a time."""
    rows = max(1, len(texts) * size // max(size, texts.nbytes))
    for start in range(0, max(1, len(texts)), rows):
        yield texts.slice(start, rows)


def detached(form: Column) -> Column:
    """The singular forms that the noun endings of a token of four letters or more allow, as an array in rule order."""
    cut = lambda ending, base: F.concat(F.left(form, F.length(form) - len(ending)), F.lit(base))
    plain = ~form.rlike("(ss|us|is)$")
    tried = [F.when(form.endswith(e) & (plain if e == "s" else F.lit(True)), cut(e, b)) for e, b in fixed.NOUN_RULES]
    return F.when(F.length(form) >= 4, F.filter(F.array(*tried), lambda c: c.isNotNull())).otherwise(F.array().cast("array<string>"))


def noun_forms(df: DataFrame, text_col: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """(form, lemma): the tokens of the texts that are not their own lemma, each resolved once.

    Irregular nouns come from a table. Other forms lose a noun ending where a known word is left, the shortest of several;
    known are all tokens of the texts and the ``form`` column of ``vocabulary``. Where no known word is left the regular
    ending is cut by rule. Texts are reduced to their distinct forms before anything is joined.
    """
    forms = df.select(F.explode(F.array_distinct(tx.tokens(F.col(text_col)))).alias("form")).distinct()
    forms = stored(forms, "noun-forms")
    known = forms.select("form")
    if vocabulary is not None:
        known = known.unionByName(vocabulary.select("form")).where("form is not null").distinct()
    tried = forms.select("form", F.posexplode(detached(F.col("form"))).alias("rule", "lemma"))
    found = tried.join(known.withColumnRenamed("form", "lemma"), "lemma", "left_semi")
    found = found.groupBy("form").agg(F.min(F.struct(F.length("lemma"), "rule", "lemma"))["lemma"].alias("found"))
    irregular = F.create_map(*[F.lit(x) for pair in fixed.IRREGULAR_NOUNS.items() for x in pair])
    lemma = F.coalesce(F.try_element_at(irregular, F.col("form")), "found", tx.noun_lemmas(F.col("form")))
    return forms.join(found, "form", "left").select("form", lemma.alias("lemma")).where("lemma <> form")


def replace_forms(df: DataFrame, text_col: str, table: DataFrame, out: str, key: str | None = None) -> DataFrame:
    """Every whitespace token replaced by its lemma in ``table`` (form, lemma), joined by one space; NULL stays NULL.

    A table of up to ``SMALL_TABLE`` characters goes to every task and texts are not moved. For a larger one tokens are
    joined to it in parts, so that a frequent word is no hot key, and put together again by ``key``, which must identify
    a row.
    """
    table = stored(table.select("form", "lemma"), "lemmas")
    size = table.agg(F.coalesce(F.sum(F.length("form") + F.length("lemma")), F.lit(0))).first()[0]
    if size <= SMALL_TABLE:
        sent = df.sparkSession.sparkContext.broadcast({r["form"]: r["lemma"] for r in table.toLocalIterator()})

        @F.arrow_udf("string")
        def replaced(texts: pa.Array) -> pa.Array:
            known, gap = sent.value, re.compile(r"[ \t\n\x0b\f\r]+")

            def one(text):
                return None if text is None else " ".join(known.get(w, w) for w in gap.split(text) if w)

            return pa.concat_arrays([pa.array([one(text) for text in part.to_pylist()], pa.string()) for part in pieces(texts)])

        return df.withColumn(out, replaced(F.col(text_col)))
    if key is None:
        raise ValueError("a large lemma table needs the key of the texts")
    part = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    tokens = df.select(key, part.alias("_part"), F.posexplode(tx.tokens(F.col(text_col))).alias("_pos", "_word"))
    spread = table.select(F.col("form").alias("_word"), "lemma", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
    word = F.struct("_pos", F.coalesce("lemma", "_word").alias("w"))
    joined = tokens.join(spread, ["_part", "_word"], "left").groupBy(key).agg(F.array_sort(F.collect_list(word)).alias("_words"))
    text = joined.select(F.col(key).alias("_key"), F.array_join(F.col("_words.w"), " ").alias(out))
    plain = F.when(F.col(text_col).isNotNull(), F.lit(""))
    rows = df.drop(out) if out != text_col else df
    rows = rows.join(text.withColumnRenamed(out, "_text"), F.col(key).eqNullSafe(F.col("_key")), "left")
    return rows.withColumn(out, F.coalesce("_text", plain)).drop("_key", "_text")


def lemmatize(
    df: DataFrame, text_col: str, lemmas: DataFrame | None = None, *, key: str | None = None, out: str = "lemmatized",
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """Replace every whitespace token by its noun lemma.

    Without ``lemmas`` the forms of the texts are resolved by ``noun_forms``. A (form, lemma) table is taken as it is:
    unknown forms and forms whose lemma is NULL stay, of several lemmas of a form the first in order is taken. ``key``
    identifies a row and is needed for large tables only. The table is made when this is called.
    """
    if lemmas is None:
        table = noun_forms(df, text_col, vocabulary)
    else:
        table = lemmas.where("form is not null and lemma is not null").groupBy("form").agg(F.min("lemma").alias("lemma"))
    return replace_forms(df, text_col, table, out, key)


ABBREVIATION = 0.3  # the score from which a form counts as an abbreviation


def learn_abbreviations(df: DataFrame, text_col: str) -> DataFrame:
    """(form, with_period, apart, score): forms that mostly stand before a period, as abbreviations do.

    The score is that of Kiss and Strunk (2006): the likelihood that form and period belong together, weighed by length,
    inner periods, and how often the form stands without. Forms are letters with single inner periods, in small letters.
    Counts are partial sums per form over all texts; the totals are one row.
    """
    words = df.select(F.explode(tx.tokens(F.col(text_col))).alias("w"))
    ends = F.col("w").endswith(".")
    form = F.lower(F.when(ends, F.left("w", F.length("w") - 1)).otherwise(F.col("w")))
    counts = words.select(form.alias("form"), ends.cast("long").alias("p")).groupBy("form").agg(
        F.sum("p").alias("with_period"), F.sum(1 - F.col("p")).alias("apart"))
    counts = stored(counts, "abbreviation-counts")
    total = counts.agg(F.sum("with_period").alias("_periods"), F.sum(F.col("with_period") + F.col("apart")).alias("_all"))
    rows = counts.where((F.col("with_period") > 0) & F.col("form").rlike(r"^\p{L}+(\.\p{L}+)*$")).crossJoin(F.broadcast(total))
    near, apart = F.col("with_period"), F.col("apart")
    chance = F.col("_periods") / F.col("_all")
    letters = F.length(F.replace("form", F.lit("."), F.lit("")))
    alone = near * F.log(chance) + F.when(apart > 0, apart * F.log(1 - chance)).otherwise(0.0)
    together = near * F.log(F.lit(0.99)) + apart * F.log(F.lit(0.01))
    inner = F.length("form") - letters + 1
    score = -2.0 * (alone - together) * F.exp(-letters) * inner * F.pow(letters.cast("double"), -apart.cast("double"))
    return rows.select("form", "with_period", "apart", score.alias("score")).where(F.col("score") >= ABBREVIATION)


def learnt_sentences(df: DataFrame, text_col: str, abbreviations: DataFrame, out: str = "sentences") -> DataFrame:
    """The input with ``out``: the sentences of each text, as in ``functions.text.split_sentences`` with these abbreviations
    (``form``). Their list goes to every task; forms are at most as many as a language has short words before a period."""
    known = {r["form"] for r in abbreviations.select("form").toLocalIterator()}
    sent = df.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        listed = sent.value
        ends = re.compile(r"(?<=[.!?])[ \t\n\x0b\f\r]+")
        last = re.compile(r"(?:^|[ \t\n\x0b\f\r(\"'])([^ \t\n\x0b\f\r(\"']*)\.$")

        def goes_on(before: str, after: str) -> bool:
            token = last.search(before[-100:])
            if token is None or before[-1] != ".":
                return False
            word = token[1]
            if word.lower() in listed or (len(word) == 1 and word.isupper()):
                return True
            return word.isascii() and word.isdigit() and len(word) <= 9 and after[:1].islower()

        def one(text):
            if text is None:
                return None
            found, start = [], 0
            for m in ends.finditer(text):
                if not goes_on(text[max(start, m.start() - 100):m.start()], text[m.end():m.end() + 1]):
                    found.append(text[start:m.start()])
                    start = m.end()
            return [s for s in [*found, text[start:]] if s]

        return texts.map(one)

    return df.withColumn(out, cut(F.col(text_col)))
