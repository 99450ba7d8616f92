"""Nested product reviews: flattening, sentences, and matching clean to raw sentences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from fieldtide.functions import text as tx


def explode_reviews(products: DataFrame) -> DataFrame:
    """One row per product and review with text; the last of equal review ids wins."""
    listed = products.where(F.col("num_reviews") > 0)
    rows = listed.select("omsid", F.posexplode("reviews").alias("_pos", "_review"))
    rows = rows.select("omsid", "_pos", F.col("_review.Id").alias("review_id"), F.col("_review.ReviewText").alias("review_text"))
    last = rows.where(F.col("review_text").isNotNull()).groupBy("omsid", "review_id")
    return last.agg(F.max_by("review_text", "_pos").alias("review_text"))


def review_id_text(products: DataFrame) -> DataFrame:
    """All (product, review id, text) entries of the review lists, missing texts included."""
    rows = products.select("omsid", F.explode("reviews").alias("_review"))
    return rows.select("omsid", F.col("_review.Id").alias("review_id"), F.col("_review.ReviewText").alias("review_text"))


class RawSentences:
    """The raw sentences of one review, ready to find the one most similar to a clean sentence.

    A clean sentence of n words is compared with every n-gram of words of every raw sentence.
    The letters two texts share bound their similarity, and these bounds are computed for all
    n-grams at once; only n-grams whose bound reaches the best similarity so far are compared
    exactly, so the result is that of comparing all.
    """

    def __init__(self, sentences: Sequence[str]):
        self.sentences = list(sentences)
        split = [s.split() for s in self.sentences]
        self.words = [w for words in split for w in words]
        self.ends = np.cumsum([0, *map(len, split)])
        self.letters = {c: i for i, c in enumerate(sorted(set("".join(self.words))))}
        counts = np.zeros((len(self.words) + 1, len(self.letters)), dtype=np.int64)
        for at, word in enumerate(self.words, 1):
            for letter, n in Counter(word).items():
                counts[at, self.letters[letter]] = n
        self.cumulated = counts.cumsum(0)
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _grams(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and sentence of every n-gram; short sentences count as a whole."""
        if width not in self.grams:
            first, last, owner = [], [], []
            for at, (start, end) in enumerate(zip(self.ends[:-1], self.ends[1:])):
                n = min(width, end - start)
                if n > 0:
                    begin = np.arange(start, end - n + 1)
                    first.append(begin)
                    last.append(begin + n)
                    owner.append(np.full(len(begin), at))
            empty = [np.zeros(0, dtype=np.int64)]
            self.grams[width] = tuple(np.concatenate(x or empty) for x in (first, last, owner))
        return self.grams[width]

    def best_match(self, query: str) -> int:
        """Position of the most similar raw sentence; the first of equal ones."""
        first, last, owner = self._grams(len(query.split()))
        wanted, blanks = np.zeros(len(self.letters), dtype=np.int64), query.count(" ")
        for letter, n in Counter(query).items():
            if letter in self.letters:
                wanted[self.letters[letter]] = n
        counts = self.cumulated[last] - self.cumulated[first]
        gaps = last - first - 1
        shared = np.minimum(counts, wanted).sum(1) + np.minimum(gaps, blanks)
        bounds = 2.0 * shared / (counts.sum(1) + gaps + len(query))
        matcher = SequenceMatcher(None)
        matcher.set_seq2(query)
        best, best_at = 0.0, 0
        for i in np.argsort(-bounds, kind="stable"):
            if bounds[i] < best or bounds[i] == 0:
                break
            at = int(owner[i])
            if bounds[i] == best and at >= best_at:
                continue
            run = " ".join(self.words[first[i]:last[i]])
            if run == query and len(query) < 200:
                score = 1.0  # from 200 letters on the matcher leaves frequent letters out, and equal texts may have less
            else:
                matcher.set_seq1(run)
                score = matcher.ratio()
            if score > best or (score == best and at < best_at):
                best, best_at = score, at
        return best_at


@F.pandas_udf(ArrayType(StringType()))
def _matched(clean: pd.Series, raw: pd.Series) -> pd.Series:
    def one(queries, sentences):
        if queries is None or sentences is None or not len(sentences):
            return None
        known = RawSentences(sentences)
        return [known.sentences[known.best_match(q)] for q in queries]

    return pd.Series([one(c, r) for c, r in zip(clean, raw)], dtype=object)


def match_sentences_by_ratio(clean: Column, raw: Column) -> Column:
    """For each clean sentence the most similar raw sentence of the same review, by the ratio of matching blocks."""
    return _matched(clean, raw)


def match_sentences(clean: Column, raw: Column) -> Column:
    """For each clean sentence the most similar raw sentence of the same review, the first of equal ones; native expressions.

    A clean sentence of n words is compared with every run of n words of a raw sentence, or with all of a shorter one. Their
    similarity is 1 - edits / length of the longer text, on the printable characters, as the clean sentences hold no others.
    Only runs that can beat the best one so far are followed to the end: the edits are counted up to what that allows, and
    runs whose length alone asks for more are not begun. Without any similarity the first raw sentence is taken. NULL where
    there are no raw sentences.
    """
    words = F.transform(raw, lambda s: tx.tokens(tx.remove_non_printable(s)))

    def compared(best: Column, run: Column, query: Column, at: Column) -> Column:
        longer = F.greatest(F.length(run), F.length(query))
        allowed = F.floor((1.0 - best["score"]) * longer + 1e-9).cast("int")

        def judged(edits: Column) -> Column:
            score = 1.0 - edits / longer
            better = (score > best["score"]) | ((score == best["score"]) & (at < best["at"]))
            return F.when((edits >= 0) & better, F.struct(score.alias("score"), at.alias("at"))).otherwise(best)

        return tx.let(F.call_function("levenshtein", run, query, allowed), judged)

    def of_sentence(best: Column, at: Column, query: Column, wanted: Column, listed: Column) -> Column:
        def all_runs(sentence: Column) -> Column:
            width = F.least(wanted, F.size(sentence))
            runs = F.transform(F.sequence(F.lit(1), F.size(sentence) - width + 1), lambda i: F.array_join(F.slice(sentence, i, width), " "))
            found = F.when(width > 0, F.aggregate(runs, best, lambda b, run: compared(b, run, query, at))).otherwise(best)
            # Nothing beats a run that is equal, and only an equal one in an earlier sentence comes before it.
            equal = (best["score"] == 1.0) & ((at >= best["at"]) | ~F.array_join(sentence, " ").contains(query))
            return F.when(equal, best).otherwise(found)

        return tx.let(F.get(listed, at), all_runs)

    def nearest(query: Column, place: Column, listed: Column) -> Column:
        none = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("at"))
        last = F.size(listed) - 1
        numbers = F.sequence(F.lit(0), last)

        def all_sentences(wanted: Column) -> Column:
            # Cleaning keeps the order, so the sentence in the same place comes first and sets the mark.
            first = of_sentence(none, F.least(place, last), query, wanted, listed)
            return tx.let(first, lambda mark: F.aggregate(numbers, mark, lambda best, at: of_sentence(best, at, query, wanted, listed)))

        return F.get(raw, tx.let(F.size(tx.tokens(query)), all_sentences)["at"])

    found = tx.let(words, lambda listed: F.when(F.size(listed) > 0, F.transform(clean, lambda q, i: nearest(q, i, listed))).otherwise(
        F.transform(clean, lambda q: F.lit(None).cast("string"))))
    return F.when(raw.isNotNull(), found)


def match_sentences_by_edits(clean: Column, raw: Column) -> Column:
    """For each clean sentence the raw sentence of the fewest edits, the first of several; native expressions.

    Edits are counted on the printable characters, as the clean sentences hold no others.
    """
    printable = F.transform(raw, tx.remove_non_printable)

    def nearest(query: Column) -> Column:
        counted = F.transform(printable, lambda s, i: F.struct(F.levenshtein(query, s).alias("edits"), i.alias("at")))
        return F.get(raw, F.array_min(counted)["at"])

    return F.transform(clean, nearest)


def review_sentences(products: DataFrame, match: Callable[[Column, Column], Column] = match_sentences) -> DataFrame:
    """Reviews with clean text, clean sentences, and the raw sentence behind each of them.

    ``match`` compares the sentences: by edits in native expressions, or ``match_sentences_by_ratio``.
    """
    # Comparing sentences costs far more than moving them: use every core, however small the rows.
    tasks = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = explode_reviews(products).repartition(tasks, "omsid", "review_id")
    cleaned = rows.withColumn("review_text_cleaned", tx.clean_text(F.col("review_text")))
    split = cleaned.select(
        "*",
        tx.split_sentences(F.col("review_text_cleaned")).alias("sentences_cleaned"),
        tx.split_sentences(F.col("review_text")).alias("_raw"),
    )
    blank = F.rtrim("review_text_cleaned") == ""
    source = F.when(~blank, F.col("_raw"))
    return split.withColumn("_raw", source).withColumn("sentences_raw", match(F.col("sentences_cleaned"), F.col("_raw"))).drop("_raw")
