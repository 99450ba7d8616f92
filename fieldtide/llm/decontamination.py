"""Benchmark decontamination by template canonicalisation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtide.llm.common import stored

WINDOW = 8           # canonical tokens of a window; shorter items are one window of their own length
LEAST = 4            # items with fewer tokens are searched for word by word only, without placeholders
LITERALS = 5         # words that a window must keep besides its placeholders (of 8; in proportion for shorter windows)
RUN = 6              # windows that must be found for a leak ...
SHARE = 0.6          # ... or this share of the item's windows where that is fewer
BITS = 23            # log2 of the bits of the filter that goes to the tasks: 1 MB, whatever the benchmark's size
GROUP = 250_000      # characters of texts that are cut into windows at once
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs oz ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years mph kmh dollar dollars cent cents euro euros pound pounds percent degree degrees".split()
)
WORD, NUMBER, UNIT, NAME = range(4)
_STRIP = ".,;:!?()[]{}\"'`*_#&|<>~…“”‘’«»¿¡-"
_NUMBER = re.compile(r"[-+$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_JOINED = re.compile(r"([-+$€£]?\d[\d.,:/]*)([a-zA-Z]+)")


class _Tokens(dict):
    """Tokens to places in arrays of what is known about each: hash, kind, whether a sentence ends."""

    ROOM = 2**19

    def __init__(self) -> None:
        self.hashes = np.zeros(self.ROOM, np.uint64)
        self.kinds = np.zeros(self.ROOM, np.int8)
        self.ends = np.zeros(self.ROOM, bool)

    def make_room(self, tokens: int) -> None:
        """Forget everything rather than grow beyond ROOM, unless one group of texts needs more."""
        if len(self) + tokens > len(self.hashes):
            self.clear()
            if tokens > len(self.hashes):
                self.hashes, self.kinds, self.ends = (np.zeros(tokens, a.dtype) for a in (self.hashes, self.kinds, self.ends))

    def __missing__(self, token: str) -> int:
        at = len(self)
        core = token.strip(_STRIP)
        low, kind = core.lower(), WORD
        if not core:
            kind = -1
        elif core[0].isupper():
            kind = NAME
        elif low in UNITS:
            kind = UNIT
        if any(c.isdigit() for c in core):
            joined = _JOINED.fullmatch(core)
            if _NUMBER.fullmatch(core) or joined and joined[2].lower() in UNITS:
                kind = NUMBER
        self.hashes[at] = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"))
        self.kinds[at] = kind
        self.ends[at] = token[-1] in ".!?:"
        self[token] = at
        return at


def canonical(texts: list[str | None], known: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, kind, text number) of the tokens of all texts. Marks without letters are dropped; a capital at the start of
    a sentence makes no name."""
    lines: list[list[str]] = []
    owners: list[int] = []
    for number, text in enumerate(texts):
        for line in (text or "").split("\n"):
            tokens = line.split()
            if tokens:
                lines.append(tokens)
                owners.append(number)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, np.int64)
    known.make_room(total)
    at = np.fromiter(map(known.__getitem__, chain.from_iterable(lines)), np.int64, total)
    kind, end = known.kinds[at], known.ends[at]
    start = np.zeros(total, bool)
    start[np.cumsum(sizes) - sizes] = True
    start[1:] |= end[:-1]
    kind[start & (kind == NAME)] = WORD
    real = kind >= 0
    return known.hashes[at][real], kind[real], np.repeat(np.array(owners, np.int64), sizes)[real]


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _rolled(value: np.ndarray, places: np.ndarray | slice, k: int, n: int) -> np.ndarray:
    total = None
    for i in range(k):
        part = value[i:n + i][places]
        total = part + np.uint64(k) if total is None else total * np.uint64(0x9E3779B97F4A7C15) + part
    return _spread(total)


def window_hashes(h: np.ndarray, kind: np.ndarray, owner: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the windows of ``k`` tokens of one text, with names as placeholders, with names as words, and with
    every token as it is.

    A placeholder hashes by its type alone. Windows with placeholders and too few words say nothing and are left out;
    tokens as they are need no least number of words, so a verbatim copy has all of its windows.
    """
    n = len(h) - k + 1
    if n <= 0:
        return
    least, whole = -(-LITERALS * k // WINDOW), owner[:n] == owner[k - 1:]
    if k < LEAST:
        places = np.flatnonzero(whole)
        yield places, _rolled(h, places, k, n)
        return

    def count(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int32)])
        return sums[k:] - sums[:-k]

    typed = kind > WORD
    value = np.where(typed, kind.astype(np.uint64), h)
    places = np.flatnonzero(whole & (k - count(typed) >= least))
    yield places, _rolled(value, places if len(places) < n else slice(None), k, n)
    if (kind == NAME).any():  # only windows with a name have another form
        typed &= kind != NAME
        value = np.where(typed, kind.astype(np.uint64), h)
        places = np.flatnonzero(whole & (count(kind == NAME) > 0) & (k - count(typed) >= least))
        yield places, _rolled(value, places, k, n)
    # Without numbers and units the form before is the text as it is.
    places = np.flatnonzero(whole & (count((kind == NUMBER) | (kind == UNIT)) > 0))
    yield places, _rolled(h, places, k, n)


def _windows(texts: DataFrame, sizes: list[int] | None, bits: np.ndarray | None) -> DataFrame:
    """(id, row, k, n, place, window, slots) of (id, row, text); ``slots`` are the hashes of the window's placeholders.

    Without ``sizes`` each text takes WINDOW or its own length. With ``bits`` only windows that may be in the
    benchmark leave the task. Texts are taken together up to GROUP characters, so short texts cost no calls of their own.
    """
    names = ["id", "row", "k", "n", "place", "window", "slots"]

    def rows(batch: pd.DataFrame, known: _Tokens) -> list[tuple]:
        h, kind, owner = canonical(batch["text"].tolist(), known)
        first = np.searchsorted(owner, np.arange(len(batch) + 1))
        length = np.diff(first)
        ids, hashes_of = batch["id"].tolist(), batch["row"].tolist()
        held = []
        for k in sizes or sorted({min(WINDOW, x) for x in length.tolist() if x}):
            for places, hashes in window_hashes(h, kind, owner, k):
                if sizes is None:  # a benchmark item has one size of window
                    own = np.minimum(WINDOW, length[owner[places]]) == k
                    places, hashes = places[own], hashes[own]
                if bits is not None:
                    low = (hashes & np.uint64(2**BITS - 1)).astype(np.int64)
                    hit = np.flatnonzero((bits[low >> 3] >> (low & 7)) & 1)
                    high = (hashes[hit] >> np.uint64(40)).astype(np.int64) & (2**BITS - 1)
                    hit = hit[((bits[high >> 3] >> (high & 7)) & 1).astype(bool)]
                    places, hashes = places[hit], hashes[hit]
                for p, w in zip(places.tolist(), hashes.view(np.int64).tolist()):
                    o = int(owner[p])
                    slots = np.where(kind[p:p + k] > WORD, h[p:p + k], 0).view(np.int64).tolist()
                    held.append((ids[o], hashes_of[o], k, int(length[o]) - k + 1, p - int(first[o]), w, slots))
        return held

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Tokens()
        for batch in batches:
            size = batch["text"].str.len().fillna(0).cumsum() // GROUP
            for _, part in batch.groupby(size, sort=False):
                if held := rows(part, known):
                    out = pd.DataFrame(held, columns=names)
                    out["id"] = out["id"].astype("Int64")
                    yield out

    return texts.mapInPandas(cut, "id long, row long, k int, n int, place int, window long, slots array<long>")


def _filter_bits(windows: DataFrame) -> np.ndarray:
    """2 ** BITS bits with two places of each window set; at most that many places reach the driver."""
    size = 2**BITS
    w = F.col("window")
    # Spark's bitmaps number their bits from 1.
    both = F.array(w.bitwiseAND(F.lit(size - 1)) + 1, F.shiftrightunsigned(w, 40).bitwiseAND(F.lit(size - 1)) + 1)
    places = windows.select(F.explode(both).alias("bit"))
    # Bits of 2**15 at a time: at most 2**(BITS - 15) rows of 4 KB.
    groups = places.groupBy(F.expr("bitmap_bucket_number(bit)").alias("g")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("b"))
    bits = np.zeros(size // 8, np.uint8)
    for r in groups.collect():
        bits[(r.g - 1) * 4096:r.g * 4096] = np.frombuffer(bytes(r.b), np.uint8)
    return bits


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, row, item, windows, found, changed): one row per document text and benchmark item that it leaks.

    Numbers, units and names of both sides become typed placeholders; windows with numbers or units also count as they
    are, so a verbatim copy of an item matches however dense in numbers it is. Windows of WINDOW tokens of the documents that
    pass a filter of fixed size meet the benchmark's windows in a hash join. Matches on one alignment are put together:
    the windows found must number RUN, or SHARE of the item's windows, and each value of the item's slots must stand for
    one value only in the document; ``changed`` tells whether a slot's value differs, as in a re-parameterised question.

    ``row`` is a hash of the text; a repeated row is reported once. Null and empty texts leak nothing; items under LEAST
    tokens are one window that must occur as it is; an empty table on either side gives no rows; other columns are ignored.
    """
    sides = benchmark.select(F.col(item).cast("long").alias("id"), F.xxhash64(item_text).alias("row"), F.col(item_text).alias("text"))
    bench = stored(_windows(sides, None, None), "benchmark-windows")
    sizes = sorted(r.k for r in bench.select("k").distinct().collect()) or [WINDOW]  # at most WINDOW lengths
    wanted = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    found = _windows(wanted, sizes, _filter_bits(bench)).select("id", "row", "k", F.col("place").alias("at"), "window", F.col("slots").alias("theirs"))
    pairs = found.join(bench.select(F.col("id").alias("item"), "k", "n", "place", "window", "slots"), ["window", "k"])
    pairs = pairs.withColumn("shift", F.col("at") - F.col("place"))
    # The values that meet on this alignment; equal windows of both forms count once.
    slots = F.filter(F.arrays_zip("slots", "theirs"), lambda z: (z["slots"] != 0) & (z["theirs"] != 0))
    runs = pairs.groupBy("id", "row", "item", "shift").agg(
        F.count_distinct("place").alias("found"), F.max("n").alias("windows"), F.array_distinct(F.flatten(F.collect_set(slots))).alias("slots"))
    consistent = F.size("slots") == F.size(F.array_distinct("slots.slots"))
    needed = F.least(F.lit(RUN), F.ceil(F.col("windows") * SHARE))
    good = runs.where((F.col("found") >= needed) & consistent)
    good = good.withColumn("changed", F.exists("slots", lambda z: z["slots"] != z["theirs"]))
    best = good.groupBy("id", "row", "item").agg(F.max(F.struct("found", "windows", "changed")).alias("best"))
    return best.select(F.col("id").alias(key), "row", F.col("item").alias(item), F.col("best.windows").cast("long").alias("windows"),
                       F.col("best.found").cast("long").alias("found"), F.col("best.changed").alias("changed"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, with their columns as they are."""
    out = stored(leaks(docs, benchmark, key, text, **names).select(F.col(key).alias("_leak_id"), F.col("row").alias("_leak_row")).distinct(), "leaks")
    return docs.join(out, F.col(key).cast("long").eqNullSafe(F.col("_leak_id")) & (F.xxhash64(text) == F.col("_leak_row")), "left_anti")
