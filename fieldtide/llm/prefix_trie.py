"""Prefix trie of conversations: node tables by minimal perfect hash, summed through parent slots.

A node is a sequence of turns that some conversation starts with. Its digest combines the digests of its turns and their
places, so the digest of the parent is known from the last turn alone, and no sequence is ever gathered.

Conversations are dealt to buckets of a few thousand turns, and each bucket is cut by depth into segments, so that neither
a hot first turn nor one endless conversation makes a large shard. A shard enumerates its distinct digests, gives every
digest a slot of its own, scatters what it knows into flat arrays and sums these through the array of parent slots from
the deepest nodes up. A node that stands in several shards is merged from one partial row per shard.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtide.llm.common import stored
from fieldtide.operators import ordered

ROWS = 4096  # turns that a bucket holds on average
SEGMENT = 32768  # depths of one segment
CHUNK = 4096  # members in one piece of a list of members


# -- the node table of one shard -------------------------------------------------------------


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """A position below ``size`` for 128-bit keys, another one at each level."""
    with np.errstate(over="ignore"):
        x = a.view(np.uint64) ^ (b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD1B54A32D192ED03 % 2**64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class NodeSlots:
    """Slots 0 to n - 1 for n distinct digests.

    Level by level, a digest that is alone at its position takes the next slot there, and the others go on to a
    smaller level. Every slot keeps its digest, so a lookup is checked and foreign digests get -1.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        n = len(a)
        slots, left, taken = np.empty(n, dtype=np.int64), np.arange(n), 0
        self.levels: list[np.ndarray] = []
        while len(left):
            size = 2 * len(left) + 1
            at = _place(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            ranks = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            found = ranks[at]
            slots[left[found >= 0]] = found[found >= 0]
            taken += int(alone.sum())
            left = left[found < 0]
            self.levels.append(ranks)
        self.a, self.b = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        self.a[slots], self.b[slots] = a, b

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, left = np.full(len(a), -1, dtype=np.int64), np.arange(len(a))
        for level, ranks in enumerate(self.levels):
            slot = ranks[_place(a[left], b[left], level, len(ranks))]
            held = slot >= 0
            right = held & (self.a[slot] == a[left]) & (self.b[slot] == b[left])
            out[left[right]] = slot[right]
            # A position that is held by another digest cannot belong to a member.
            left = left[~held]
        return out


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of one row of each digest."""
    order = np.lexsort((b, a))
    first = np.ones(len(a), dtype=bool)
    first[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    return order[first]


def _parents(slots: NodeSlots, p1: np.ndarray, p2: np.ndarray, depth: np.ndarray) -> np.ndarray:
    return np.where(depth > 0, slots.find(p1, p2), -1)


def _upwards(depth: np.ndarray, parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, slots of their parents) per depth, deepest first, where the parent is in the shard."""
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    if len(order):
        for part in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            yield part, parent[part]


PARTIAL = "bucket long, segment long, d1 long, d2 long, p1 long, p2 long, depth long, size long, n_convs long, least long"


def _shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of a shard with the members that the shard knows of and the smallest of them."""
    col = {c: rows[c].to_numpy(dtype=np.int64) for c in ("conv", "pos", "d1", "d2", "p1", "p2", "size")}
    slots = NodeSlots(*(col[c][_distinct(col["d1"], col["d2"])] for c in ("d1", "d2")))
    at = slots.find(col["d1"], col["d2"])
    flat = {c: np.zeros(len(slots.a), dtype=np.int64) for c in ("pos", "p1", "p2", "size")}
    for name, values in flat.items():
        values[at] = col[name]
    parent = _parents(slots, flat["p1"], flat["p2"], flat["pos"])
    # A conversation counts at its last turn in the shard and is passed on from there.
    last = np.lexsort((col["pos"], col["conv"]))
    last = last[np.r_[np.diff(col["conv"][last]) != 0, True]]
    members = np.bincount(at[last], minlength=len(slots.a))
    least = np.full(len(slots.a), np.iinfo(np.int64).max)
    np.minimum.at(least, at[last], col["conv"][last])
    for below, above in _upwards(flat["pos"], parent):
        np.add.at(members, above, members[below])
        np.minimum.at(least, above, least[below])
    return pd.DataFrame({
        "bucket": rows["bucket"].iloc[0], "segment": rows["segment"].iloc[0], "d1": slots.a, "d2": slots.b, "p1": flat["p1"],
        "p2": flat["p2"], "depth": flat["pos"], "size": flat["size"], "n_convs": members, "least": least,
    })


SUMMED = "d1 long, d2 long, p1 long, p2 long, depth long, leaves long, saved long, parent_least long"


def _shard_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Leaves and saved tokens below the nodes of a shard, and the smallest member of each parent."""
    col = {c: rows[c].to_numpy(dtype=np.int64) for c in ("d1", "d2", "p1", "p2", "depth", "leaves", "saved", "least")}
    slots = NodeSlots(col["d1"], col["d2"])
    at = slots.find(col["d1"], col["d2"])
    flat = {}
    for name in ("p1", "p2", "depth", "leaves", "saved", "least"):
        flat[name] = np.zeros(len(slots.a), dtype=np.int64)
        flat[name][at] = col[name]
    parent = _parents(slots, flat["p1"], flat["p2"], flat["depth"])
    for below, above in _upwards(flat["depth"], parent):
        np.add.at(flat["leaves"], above, flat["leaves"][below])
        np.add.at(flat["saved"], above, flat["saved"][below])
    out = pd.DataFrame({"d1": slots.a, "d2": slots.b, **{c: flat[c] for c in ("p1", "p2", "depth", "leaves", "saved")}})
    above = pd.array(flat["least"][parent], dtype="Int64")
    above[parent < 0] = pd.NA
    return out.assign(parent_least=above)


# -- lists of members ------------------------------------------------------------------------


def _runs(batch: pd.DataFrame) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(digest, from, to) of the rows of one digest in a sorted batch."""
    a, b = batch["d1"].to_numpy(), batch["d2"].to_numpy()
    cuts = np.r_[0, np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1, len(a)] if len(a) else np.zeros(1, dtype=np.int64)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield (int(a[lo]), int(b[lo])), int(lo), int(hi)


def _member_pieces(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        convs, out = batch["conv"].to_numpy(), []
        for key, lo, hi in _runs(batch):
            out += [(*key, int(convs[i]), ",".join(map(str, convs[i:min(i + CHUNK, hi)]))) for i in range(lo, hi, CHUNK)]
        yield pd.DataFrame(out, columns=["d1", "d2", "first", "piece"])


def _member_digests(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the pieces of each digest, joined by commas; a list is read as a stream and never held."""
    key, state = None, None
    for batch in batches:
        pieces, out = batch["piece"].to_numpy(), []
        for new, lo, hi in _runs(batch):
            if new != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = new, hashlib.sha256(",".join(pieces[lo:hi]).encode())
            else:
                state.update(("," + ",".join(pieces[lo:hi])).encode())
        yield pd.DataFrame(out, columns=["d1", "d2", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["d1", "d2", "ends_sha256"])


def _ends(rows: DataFrame, tasks: int) -> DataFrame:
    """(d1, d2, ends_sha256): the members that end at a node, in ascending order.

    Pieces of the lists are joined range by range, so a node at which a third of all conversations end is spread; only
    the hash itself, which has to see the pieces in order, runs in one task per node.
    """
    sorted_rows = rows.repartitionByRange(tasks, "d1", "d2", "conv").sortWithinPartitions("d1", "d2", "conv")
    pieces = sorted_rows.mapInPandas(_member_pieces, "d1 long, d2 long, first long, piece string")
    pieces = pieces.repartition(tasks, "d1", "d2").sortWithinPartitions("d1", "d2", "first")
    return pieces.mapInPandas(_member_digests, "d1 long, d2 long, ends_sha256 string")


# -- steps and trie --------------------------------------------------------------------------


def steps(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, s1, s2, size): the turns of every conversation numbered from 1, with a 128-bit digest of role and text.

    Null turns come first, ties go by role and text, repeated rows stay turns of their own. Null roles and texts count as
    empty. Rows without a conversation belong to none and are left out. ``size`` is the text's length in code points.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("role"), said.alias("text"),
        F.xxhash64(who, said).alias("s1"), F.xxhash64(said, who, F.lit(1)).alias("s2"), F.length(said).cast("long").alias("size"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return ordered.numbered(rows, ["conv"], order, number="pos").select("conv", F.col("pos").cast("long").alias("pos"), "s1", "s2", "size")


def whole(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps as they are, as the paths and lengths that ``prefix_nodes`` takes."""
    kept = stored(numbered, "trie-steps")
    return kept, kept.groupBy("conv").agg(F.max("pos").alias("n"))


def _digested(paths: DataFrame, convs: DataFrame, deepest: int, buckets: int, segment: int) -> DataFrame:
    """Every prefix of every conversation with its digest and that of its parent; the root is the prefix of no turns."""
    root = convs.select("conv", F.lit(0).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "size")])
    rows = paths.select("conv", "pos", F.xxhash64("pos", "s1", "s2").alias("t1"), F.xxhash64("s2", "pos", "s1").alias("t2"), "size")
    rows = root.unionByName(rows).withColumn("segment", F.floor(F.col("pos") / segment))
    upto = Window.partitionBy("conv", "segment").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.bit_xor("t1").over(upto).alias("d1"), F.bit_xor("t2").over(upto).alias("d2"))
    if deepest >= segment:
        before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy("conv", "segment").agg(F.bit_xor("t1").alias("o1"), F.bit_xor("t2").alias("o2"))
        offsets = totals.select("conv", "segment", F.bit_xor("o1").over(before).alias("o1"), F.bit_xor("o2").over(before).alias("o2"))
        rows = rows.join(offsets.where("segment > 0"), ["conv", "segment"], "left")
        for i in (1, 2):
            rows = rows.withColumn(f"d{i}", F.col(f"d{i}").bitwiseXOR(F.coalesce(F.col(f"o{i}"), F.lit(0).cast("long"))))
    bucket = F.pmod(F.xxhash64("conv"), F.lit(buckets)).cast("long")
    return stored(rows.select(
        "conv", "pos", "segment", bucket.alias("bucket"), "d1", "d2", F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"),
        F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"), "size"), "trie-prefixes")


def prefix_nodes(paths: DataFrame, convs: DataFrame, rows_per_bucket: int = ROWS, segment: int = SEGMENT) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``paths`` has (conv, pos, s1, s2, size) with positions 1 to n of every conversation, ``convs`` has (conv, n) once per
    conversation, also for those without turns; see ``steps`` and ``whole``. Members of a node are the conversations that
    start with it, ``n_leaves`` counts the childless nodes of its subtree, itself included, ``saved_tokens`` sums
    (members - 1) times size over its subtree, and ``ends_sha256`` is the SHA-256 of the ids of the members that end at
    the node, ascending, joined by commas (none: of the empty string). Without conversations there are no nodes.

    Texts are not read here, so their length plays no part. Equal conversations share their nodes and differ in the list
    of ends only. The list of ends of one node is hashed in order by one task, piece by piece. Depths are worked off in
    segments, deepest first: the number of steps is the longest conversation's length over ``segment``.
    """
    spark = paths.sparkSession
    deepest, total = convs.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") + 1), F.lit(0))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _digested(paths, convs, deepest, max(1, math.ceil(total / rows_per_bucket)), segment)
    partial = stored(rows.groupBy("bucket", "segment").applyInPandas(_shard_nodes, PARTIAL), "trie-shards")
    node, one = ["d1", "d2"], ["p1", "p2", "depth", "size"]
    nodes = partial.groupBy(*node).agg(*[F.max(c).alias(c) for c in one], F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"))
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes, "trie-children")
    # What a node adds by itself is scattered in the one shard that holds its smallest member.
    known = nodes.select(*node, F.col("least").alias("all_least"), (F.col("n_children") == 0).alias("leaf"),
                         ((F.col("n_convs") - 1) * F.col("size")).alias("own"))
    placed = partial.select("bucket", "segment", *node, "p1", "p2", "depth", "least").join(known, node)
    owner = F.col("least") == F.col("all_least")
    placed = placed.select(
        "bucket", "segment", *node, "p1", "p2", "depth", owner.alias("owner"), F.col("all_least").alias("least"),
        F.when(owner & F.col("leaf"), 1).otherwise(0).cast("long").alias("leaves"), F.when(owner, F.col("own")).otherwise(0).alias("saved"))
    placed = stored(placed, "trie-placed")
    summed, carried = None, None
    for part in range(deepest // segment, -1, -1):
        shards = placed.where(F.col("segment") == part)
        if carried is not None:
            # The subtrees below the segment's last depth count at their parents.
            shards = shards.join(carried, node, "left")
            for c in ("leaves", "saved"):
                more = F.when(F.col("owner"), F.coalesce(f"more_{c}", F.lit(0).cast("long"))).otherwise(0)
                shards = shards.withColumn(c, F.col(c) + more)
        sums = stored(shards.drop("owner", "more_leaves", "more_saved").groupBy("bucket", "segment").applyInPandas(_shard_sums, SUMMED), "trie-sums")
        summed = sums if summed is None else summed.unionByName(sums)
        tops = sums.where(F.col("depth") == part * segment)
        carried = tops.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    subtrees = summed.groupBy(*node).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("parent_least").alias("parent_conv_id"))
    out = nodes.join(subtrees, node)
    if deepest >= segment:
        # The parent of a segment's first depth stands in another shard.
        above = nodes.where(F.col("depth") % segment == segment - 1).select(
            F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("least").alias("above_least"))
        tops = out.where((F.col("depth") % segment == 0) & (F.col("depth") > 0)).join(above, ["p1", "p2"])
        out = out.join(tops.select(*node, "above_least"), node, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_least"))
    lengths = convs.select(F.col("conv").alias("_conv"), F.col("n").alias("_n"))
    last = rows.join(lengths, (F.col("conv") == F.col("_conv")) & (F.col("pos") == F.col("_n"))).select(*node, "conv")
    out = out.join(_ends(last, tasks), node, "left")
    return out.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
