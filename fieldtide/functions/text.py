"""Text cleaning as native expressions (no Python per row)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldtide.functions import fixed_values as fixed


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def remove_non_printable(text: Column) -> Column:
    return F.regexp_replace(text, fixed.NON_PRINTABLE, "")


def _mapped(word: Column, mapping: Mapping[str, str]) -> Column:
    # isin() on literals is a hash probe; the slower map lookup runs for listed words only.
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.when(F.lower(word).isin(list(mapping)), table[F.lower(word)]).otherwise(word)


def single_spaced(text: Column) -> Column:
    """The tokens of a text joined by one space."""
    # Single blanks, the usual case, do not match and are not rewritten.
    return F.trim(F.regexp_replace(text, r"\s{2,}|[\t\n\x0B\f\r]", " "))


def expand_contractions(text: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Replace whole tokens found in ``mapping`` (lower-cased) and join by one space.

    Texts without an apostrophe and without any of the plain listed words skip the token loop.
    """
    table = dict(mapping or fixed.CONTRACTIONS)
    plain = [re.escape(w) for w in table if "'" not in w]
    maybe = text.contains("'") if len(plain) < len(table) else F.lit(False)
    if plain:
        maybe = maybe | F.concat(F.lit(" "), text).rlike(rf"(?i)\s(?:{'|'.join(plain)})(?!\S)")
    expanded = F.array_join(F.transform(tokens(text), lambda w: _mapped(w, table)), " ")
    return F.when(maybe, expanded).otherwise(single_spaced(text))


def replace_urls(text: Column, token: str = fixed.URL_TOKEN) -> Column:
    """Scheme and host become ``token``; the path stays."""
    return F.regexp_replace(text, fixed.URL_PATTERN, token)


def drop_phrases(text: Column, phrases: Sequence[str] = fixed.JUNK_PHRASES) -> Column:
    for phrase in phrases:
        text = F.replace(text, F.lit(phrase), F.lit(" "))
    return text


def clean_text(
    text: Column,
    mapping: Mapping[str, str] | None = None,
    phrases: Sequence[str] = fixed.JUNK_PHRASES,
    rewrites: Iterable[tuple[str, str]] = fixed.REWRITES,
) -> Column:
    """Printable characters, contractions, URLs, junk phrases, fixed rewrites, in this order."""
    text = drop_phrases(replace_urls(expand_contractions(remove_non_printable(text), mapping)), phrases)
    for old, new in rewrites:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def stop_word_filter(words: Column, stop: Sequence[str] = fixed.STOP_NOUNS) -> Column:
    """Token array without the listed words (compared in lower case)."""
    return F.filter(words, lambda w: ~F.lower(w).isin(list(stop)))


def standardize_terms(words: Column, mapping: Mapping[str, str] = fixed.STANDARD_TERMS) -> Column:
    """Token array with variants replaced by their standard term."""
    return F.transform(words, lambda w: _mapped(w, mapping))


OPENED = r"(?:^|[\s(\"'])"  # what stands before a token


def split_sentences(text: Column, abbreviations: Sequence[str] = fixed.ABBREVIATIONS) -> Column:
    """Sentences end at . ! or ? followed by white space.

    A listed abbreviation (without its last period, in any case), a capital initial, and a number before a word in small
    letters do not end one. ``operators.text.learnt_sentences`` takes the abbreviations from the texts themselves.
    """
    listed = "|".join(re.escape(a) for a in abbreviations)
    short = rf"(?<!{OPENED}(?i:{listed})\.)" if listed else ""
    initial, number = rf"(?<!{OPENED}\p{{Lu}}\.)", rf"(?<!{OPENED}[0-9]{{1,9}}\.)"
    ends = rf"(?<=[.!?]){short}{initial}(?:{number}\s++|\s++(?!\p{{Ll}}))"
    return F.filter(F.split(text, ends), lambda s: s != "")


def join_list(items: Column, separator: str) -> Column:
    return F.array_join(items, separator)


# Regular English noun endings of tokens of four letters or more: ies->y, (ss|x|z|ch|sh)es->es cut,
# (l|r)ves->f, men->man, and at last s, but not in ss, us, is.
# The ending comes first in each pattern and what precedes it is looked up after it was found.
NOUN_ENDINGS = (
    (r"ies(?!\S)(?<=[^aeiou\s]ies)", "y"),
    (r"ves(?!\S)(?<=[lr]ves)", "f"),
    (r"men(?!\S)(?<=\Smen)", "man"),
    (r"es(?!\S)(?<=(?:ss|\Sx|\Sz|ch|sh)es)|s(?!\S)(?<=\S\S[^sui\s]s)", ""),
)


def noun_lemmas(text: Column) -> Column:
    """Every token with its regular noun ending removed; works on whole texts, not per token."""
    text = single_spaced(text)
    for ending, base in NOUN_ENDINGS:
        text = F.regexp_replace(text, ending, base)
    return text
