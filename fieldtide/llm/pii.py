"""Personal data: regular expressions propose spans, checksums confirm them, nearby words move their score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.llm.common import ascii_lower

LEAST = 0.5  # the score from which a span of an added kind is reported
BEFORE, AFTER = 40, 20  # code points of context before and after a span
BLOCK = 64  # lengths that are summed at a time

# Lengths of account numbers by country, as registered.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MT": 31,
    "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` proposes spans, leftmost first and without overlap; ``needs`` is a part that every text with a span
    holds. ``confirm`` judges a proposal, ``alone`` asks for no letter, digit or hyphen on either side. ``score`` is that of a span without context; ``words`` nearby add to it and ``against`` take from it.
    ``base`` kinds are reported whatever their score.
    """

    name: str
    pattern: str
    score: float
    words: Sequence[str]
    against: Sequence[str] = ()
    needs: str | None = None
    confirm: Callable[[Column], Column] | None = None
    alone: bool = False
    base: bool = False


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


def is_card(value: Column) -> Column:
    """12 to 19 digits with a right Luhn digit."""
    return F.when(F.length(digits(value)).between(12, 19), F.call_function("luhn_check", digits(value))).otherwise(False)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def iban_pattern() -> str:
    """An account number by country: check digits, then as many letters and digits as the country has, in any groups."""
    by_length: dict[int, list[str]] = {}
    for country, size in IBAN_LENGTHS.items():
        by_length.setdefault(size, []).append(country)
    return "(?:" + "|".join(f"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in sorted(by_length.items())) + ")"


def is_iban(value: Column) -> Column:
    """The number of the rearranged letters and digits leaves 1 when divided by 97."""
    plain = F.replace(value, F.lit(" "))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))
    values = F.transform(F.split(moved, ""), lambda c: F.instr(F.lit(SYMBOLS), c) - 1)
    return F.aggregate(values, F.lit(0), lambda n, v: (n * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def is_ssn(value: Column) -> Column:
    area, group, serial = F.left(value, F.lit(3)), F.substring(value, 5, 2), F.right(value, F.lit(4))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


def is_date(value: Column) -> Column:
    first, second = F.regexp_extract(value, "^([0-9]+)", 1).cast("int"), F.regexp_extract(value, "^[0-9]+.([0-9]+)", 1).cast("int")
    return (F.least(first, second).between(1, 12)) & (F.greatest(first, second).between(1, 31))


# Groups repeat without being tried again, so that a run of any length is matched in one sweep, and a local part starts
# where none of its letters stands before it or the last match ended; neither changes what the pattern finds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.8,
         ("email", "mail", "contact", "write"), ("example",), needs="@", base=True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", 0.5, ("ip", "address", "host", "server"),
         ("version", "release", "section"), needs=".", confirm=is_ip, base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.6, ("card", "visa", "mastercard", "credit", "amex"),
         ("order", "invoice", "tracking"), confirm=is_card, base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, ("phone", "tel", "call", "mobile", "fax"), ("sum",), needs="+",
         confirm=is_phone, base=True),
    Kind("iban", iban_pattern(), 0.8, ("iban", "bank", "account"), confirm=is_iban, alone=True),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, ("ssn", "social", "security"), ("part", "serial"), needs="-", confirm=is_ssn, alone=True),
    Kind("birth", r"[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}", 0.2, ("born", "birth", "birthday", "dob", "geboren", "nacido"),
         ("issued", "expires"), confirm=is_date, alone=True),
)
GAIN = 0.3
NONE = "array<struct<start:int,place:int,kind:string,end:int,value:string,score:double>>"


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def running(lengths: Column) -> Column:
    """Running sums of an array of ints: sums inside blocks, then of the blocks before, so no step copies the array."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda s, v: s + v)

    def joined(blocks: Column) -> Column:
        sums = F.transform(blocks, total)
        return bound(sums, lambda s: F.flatten(F.transform(blocks, lambda b, i: bound(
            total(F.slice(s, F.lit(1), i)), lambda before: F.transform(b, lambda _, j: before + total(F.slice(b, F.lit(1), j + 1)))))))

    def cut(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))
        return F.when(F.size(values) > 0, bound(F.transform(starts, lambda i: F.slice(values, i, F.lit(BLOCK))), joined)).otherwise(
            F.array().cast("array<int>"))

    return bound(lengths, cut)


def context(before: Column, after: Column) -> Column:
    """The words next to a span, a word being letters a to z of either case."""
    near = F.concat(F.right(before, F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER)))
    return F.split(ascii_lower(near), "[^a-z]+")


def spans_of(text: Column, kind: Kind, place: int) -> Column:
    """The confirmed spans of one kind in order, as structs (start, place, kind, end, value, score)."""
    empty = F.array().cast(NONE)

    def judged(pieces: Column, found: Column) -> Column:
        # The text is piece, match, piece, match, ..., piece.
        ends = running(F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m)))

        def span(at: Column, i: Column) -> Column:
            value = F.get(found, i)
            start = at - F.length(value)
            before, after = F.get(pieces, i), F.get(pieces, i + 1)
            words = context(before, after)
            score = F.lit(kind.score)
            score = score + F.when(F.arrays_overlap(words, F.array(*map(F.lit, kind.words))), GAIN).otherwise(0.0)
            if kind.against:
                score = score - F.when(F.arrays_overlap(words, F.array(*map(F.lit, kind.against))), GAIN).otherwise(0.0)
            right = kind.confirm(value) if kind.confirm else F.lit(True)
            if kind.alone:
                right = right & ~F.right(before, F.lit(1)).rlike("[A-Za-z0-9-]") & ~F.left(after, F.lit(1)).rlike("[A-Za-z0-9-]")
            score = F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2)
            if not kind.base:
                right = right & (score >= LEAST)
            made = F.struct(start.cast("int").alias("start"), F.lit(place).alias("place"), F.lit(kind.name).alias("kind"),
                            at.cast("int").alias("end"), value.alias("value"), score.alias("score"))
            return F.when(F.coalesce(right, F.lit(False)), made)

        return F.filter(F.transform(ends, span), lambda s: s.isNotNull())

    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    some = bound(found, lambda f: F.when(F.size(f) > 0, bound(F.split(text, kind.pattern, -1), lambda p: judged(p, f))).otherwise(empty))
    return F.when(text.contains(kind.needs), some).otherwise(empty) if kind.needs else some


def find_personal_data(df: DataFrame, text: str = "text", kinds: Sequence[Kind] = KINDS, out: str = "spans") -> DataFrame:
    """The input with ``out``: the spans of personal data, sorted by start and then kind.

    A span is a struct (start, place, kind, end, value, score); start and end count code points from 0, the end is not
    part of it. Kinds are searched on their own, so spans of different kinds may overlap. A text is one row from reading to
    writing: nothing is shuffled, no key or hot group plays a part, and a lost task is simply read again.

    Null and empty texts have no spans, very long texts are searched whole, repeated rows each get theirs, an empty table
    stays empty. Spans with equal starts are told apart by the order of the kinds. All other columns are passed on; a
    column named ``out`` is replaced.
    """
    spans = [spans_of(F.coalesce(F.col(text), F.lit("")), kind, place) for place, kind in enumerate(kinds)]
    return df.withColumn(out, F.array_sort(F.concat(*spans)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
