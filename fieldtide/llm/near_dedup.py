"""Near-duplicate documents by SetSketch registers: band, estimate by likelihood, verify on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtide.llm.common import components, stored

WIDTH = 5            # words of a shingle
ROWS = 6             # registers of a band
MISS = 1e-8          # chance that a pair exactly at the threshold shares no band
BASE = 1.001         # spacing of register values
RATE = 20.0          # rate of the exponential variates
TOP = 2**16 - 2      # register values are truncated to 0 .. TOP + 1
SURE = 18.0          # log-likelihood by which the estimate must beat the threshold to reject a pair
BLOCK_DOCS = 512     # expected documents of a block in the verification
BLOCK_SHINGLES = 2**20
CHUNK = 2**15        # shingles sketched at once


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


class _Words(dict):
    """Hashes of words; forgets them when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, seen: _Words, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; with fewer words the whole sequence is one."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(seen.__getitem__, parts), np.uint64, len(parts))
    k = min(width, len(parts))
    h = np.full(len(parts) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(parts) - k + 1 + i]
    return np.unique(_mixed(h))


def _multipliers(m: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20210)
    return (draw.integers(0, 2**32, m, dtype=np.uint32) | np.uint32(1)), draw.integers(0, 2**32, m, dtype=np.uint32)


def sketches(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SetSketch registers of non-empty sets, one row each.

    A register is floor(1 - log_b x) of the least exponential variate x of the set, truncated; the register of a
    union is the larger of the two (``np.maximum``), and equal registers are likelier the more the sets share.
    """
    times, flips = _multipliers(m)
    out = np.empty((len(sets), m), np.uint16)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= CHUNK):
            size += len(sets[last])
            last += 1
        h = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        least = np.empty((m, last - first), np.uint32)
        work = np.empty_like(h)
        for i in range(m):
            np.bitwise_xor(h, flips[i], out=work)
            np.multiply(work, times[i], out=work)
            work ^= work >> np.uint32(15)
            least[i] = np.minimum.reduceat(work, starts)
        x = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
        out[first:last] = np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP + 1)
        first = last
    return out


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band: its number and its register values."""
    n, m = registers.shape
    parts = registers.reshape(n, m // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, m // rows + 1, dtype=np.uint64), (n, m // rows)).copy()
    for i in range(rows):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key.view(np.int64)


def possible(equal: np.ndarray, above: np.ndarray, below: np.ndarray, nu: np.ndarray, nv: np.ndarray, threshold: float) -> np.ndarray:
    """Joint likelihood of (registers equal, larger, smaller) for given set sizes: may the pair reach the threshold?

    The probability that a register of U is larger is p(u - vJ), with p(x) = -log_b(1 - x (b - 1) / b), u and v the
    sizes over their sum. A pair is rejected if some similarity below the threshold is likelier than the threshold
    by SURE. Sizes alone that rule the threshold out reject too.
    """
    u = nu / (nu + nv)
    v = 1 - u
    sized = np.minimum(nu, nv) >= threshold * np.maximum(nu, nv) * (1 - 1e-12)

    def likelihood(j: float) -> np.ndarray:
        p = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-9, 1)
        more, less = p(u - v * j), p(v - u * j)
        return above * np.log(more) + below * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-9))

    best = np.full(len(u), -np.inf)
    for j in np.linspace(0, threshold, 18)[:-1]:
        best = np.maximum(best, likelihood(j))
    return sized & (best - likelihood(threshold) < SURE)


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def links_between(sets: list[np.ndarray], registers: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j), i in ``left`` and j in ``right``, that connect all that is linked between the two.

    Pairs that the likelihood leaves open are counted exactly: shingles that several sets hold are columns of a 0/1
    matrix whose product gives all intersections.
    """
    n = np.array([len(s) for s in sets], np.int64)
    pairs = []
    for i in left:
        js = right[right > i] if left is right else right
        js = js[(np.minimum(n[i], n[js]) * 100 >= percent * np.maximum(n[i], n[js]))]
        if len(js):
            other = registers[js]
            equal, above = (registers[i] == other).sum(1), (registers[i] > other).sum(1)
            js_open = js[possible(equal, above, registers.shape[1] - equal - above, np.full(len(js), n[i], float), n[js].astype(float), percent / 100)]
            pairs.append(np.stack([np.full(len(js_open), i), js_open], 1))
    pairs = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    if not len(pairs):
        return []
    if len(pairs) <= 8:
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs])
    else:
        used, place = np.unique(pairs, return_inverse=True)
        place = place.reshape(pairs.shape)
        owner = np.repeat(np.arange(len(used)), n[used])
        _, column, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        owner, column = owner[shared], (np.cumsum(count > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        rows, cols = np.unique(place[:, 0]), np.unique(place[:, 1])
        total = np.zeros((len(rows), len(cols)), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
            a, b = np.searchsorted(column, [at, at + 2048])
            held = np.zeros((len(used), 2048), np.float32)
            held[owner[a:b], column[a:b] - at] = 1
            total += held[rows] @ held[cols].T
        both = total[np.searchsorted(rows, place[:, 0]), np.searchsorted(cols, place[:, 1])].astype(np.int64)
    size = n[pairs[:, 0]] + n[pairs[:, 1]] - both
    parent, found = list(range(len(sets))), []
    for i, j in pairs[100 * both >= percent * size]:
        a, b = _find(parent, i), _find(parent, j)
        if a != b:
            parent[b] = a
            found.append((int(i), int(j)))
    return found


def _sketch_table(docs: DataFrame, key: str, text: str, percent: int, rows: int) -> DataFrame:
    m = bands_for(percent, rows) * rows
    source = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _Words()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                sets = [shingles(t, seen) for t in part["text"]]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                for i, keys in zip(full, band_keys(sketches([sets[i] for i in full], m), rows) if full else ()):
                    bands[i] = keys
                yield pd.DataFrame({
                    "id": part["id"].to_numpy(), "hash": part["hash"].to_numpy(), "n": [len(s) for s in sets],
                    "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "bands": bands,
                })

    return source.mapInPandas(sketch, "id long, hash long, n long, node binary, bands array<long>")


def _members(docs: DataFrame, clusters: DataFrame, key: str, text: str, m: int) -> DataFrame:
    """(node, cluster, n, registers, hashes) of one document per class that shares a band with another class."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    wanted = source.join(clusters, source["id"].eqNullSafe(clusters["rep_id"]) & (source["hash"] == clusters["rep_hash"]))
    wanted = wanted.select("node", "cluster", "text")

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _Words()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                sets = [shingles(t, seen) for t in part["text"]]
                yield pd.DataFrame({
                    "node": part["node"].to_numpy(), "cluster": part["cluster"].to_numpy(), "n": [len(s) for s in sets],
                    "registers": [r.tobytes() for r in sketches(sets, m)], "hashes": [s.tobytes() for s in sets],
                })

    return wanted.mapInPandas(full, "node binary, cluster binary, n long, registers binary, hashes binary")


def _block_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what is linked in each cluster.

    A cluster is dealt into blocks of bounded expected size; one unit of work is a pair of blocks. A cluster of one
    block is one unit. Units of a partition are streamed in order, so a task holds one unit at a time.
    """
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    size = size.where("docs > 1")
    parts = F.ceil(F.greatest(F.col("docs") / BLOCK_DOCS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    dealt = members.join(size.select("cluster", parts.alias("parts")), "cluster")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    unit = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))
    dealt = dealt.select(unit.alias("unit"), "cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                         "block", "node", "registers", "hashes")
    ordered = dealt.repartition("unit", "cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "block", "node")

    def work(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        registers = np.stack([np.frombuffer(r[5], np.uint16) for r in rows])
        block = np.array([r[3] for r in rows])
        low, high = np.flatnonzero(block == rows[0][1]), np.flatnonzero(block == rows[0][2])
        if rows[0][1] == rows[0][2]:
            high = low
        found = links_between(sets, registers, low, high, percent)
        return [(rows[i][4], rows[j][4]) for i, j in found]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        found: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for r in batch[["cluster", "lo", "hi", "block", "node", "registers", "hashes"]].itertuples(index=False, name=None):
                if held and held[0][:3] != r[:3]:
                    found += work(held)
                    held = []
                held.append(r)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])
                found = []
        if held:
            found += work(held)
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])

    return ordered.mapInPandas(verify, "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, rows: int = ROWS,
                    root: bool = False) -> DataFrame:
    """(key, n_shingles, component_id, kept, text_hash), one row per input row, for the graph of documents whose sets of 5-word
    shingles have 100 * intersection >= percent * union.

    1. Equal sets become one class (an aggregate on a 128-bit digest), so exact copies cost one row each and no pair.
    2. Classes that share a band are joined by stars around the smallest class of the band; the components of the
       stars are clusters, which hold every candidate pair. A pair at the threshold is missed with chance MISS.
    3. In each cluster, cut into blocks, the likelihood of the registers decides which pairs stay open, and these are
       counted on their full sets. Only links that connect something new leave a task.
    4. Components of the links; component_id is the smallest key in them.

    A row without words has n_shingles 0 and is its own component. A null key is no candidate for component_id; a
    component of null keys has component_id null and keeps its rows. Repeated rows with the same key are kept
    together. ``text_hash`` (xxhash64 of the text) tells rows of one key apart. With
    ``root`` a column of that name tells components of null keys apart, null for rows without words. An empty table gives no rows. Other
    columns are ignored.
    """
    m = bands_for(percent, rows) * rows
    sketch = stored(_sketch_table(docs, key, text, percent, rows), "sketches")
    classes = sketch.where("n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("rep"), F.any_value("bands").alias("bands"))
    classes = stored(classes.select("node", F.col("rep.id").alias("rep_id"), F.col("rep.hash").alias("rep_hash"), "bands"), "classes")
    bands = classes.select("node", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    stars = bands.join(hubs, "band").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    clusters = components(stars, random_nodes=True).toDF("node", "cluster")
    clusters = clusters.join(classes.drop("bands"), "node").select("node", "cluster", "rep_id", "rep_hash")
    members = stored(_members(docs, clusters, key, text, m), "members")
    links = stored(_block_links(members, percent), "links")
    labels = components(links, random_nodes=True).toDF("node", "root")
    roots = classes.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "rep_id")
    least = roots.groupBy("root").agg(F.min("rep_id").alias("component_id"))
    # Classes that stand alone need no second look at their root.
    ids = roots.join(least, "root").select("node", "root", "component_id")
    out = sketch.select("id", "hash", "n", "node").join(ids, "node", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"), F.col("hash").alias("text_hash"), *(["root"] if root else []))
