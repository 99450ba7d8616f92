"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from fieldtide.llm.common import byte_length, scratch

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Which shard owns a slot, by version. Its size is fixed by the number of slots, not by the data.

    Version 0 deals the slots out in turn. Each later version is the one before it with some slots
    moved; records never change their slot, so only the records of moved slots change their shard.
    """

    slots: int
    shards: int
    versions: tuple[tuple[int, ...], ...] = field(default=())

    @staticmethod
    def first(slots: int, shards: int) -> SlotMap:
        return SlotMap(slots, shards, (tuple(s % shards for s in range(slots)),))

    @property
    def current(self) -> tuple[int, ...]:
        return self.versions[-1]

    def edited(self, loads: Mapping[int, int], shards: int | None = None) -> SlotMap:
        """A new version in which slots move from the fullest to the emptiest shard while that helps.

        Each step moves the slot that comes nearest to half the difference, or swaps the pair of slots
        that does; the spread shrinks with each step, so the steps end.
        """
        shards = shards or self.shards
        owner = list(self.current)
        members: list[dict[int, int]] = [{} for _ in range(shards)]
        for slot, shard in enumerate(owner):
            members[shard][slot] = loads.get(slot, 0)
        total = [sum(m.values()) for m in members]
        while True:
            high = max(range(shards), key=lambda s: (total[s], s))
            low = min(range(shards), key=lambda s: (total[s], s))
            gap = total[high] - total[low]
            moves = [(abs(gap - 2 * n), slot, None, n) for slot, n in members[high].items() if 0 < n < gap]
            if not moves or min(moves)[0] > gap // 8:
                theirs = sorted(((n, slot) for slot, n in members[low].items()), reverse=True)
                at = 0
                for n, slot in sorted(((n, slot) for slot, n in members[high].items()), reverse=True):
                    # The slot of the emptiest shard that is smaller by about half the difference.
                    while at + 1 < len(theirs) and theirs[at][0] > n - gap // 2:
                        at += 1
                    for other, back in theirs[max(0, at - 1):at + 1]:
                        if 0 < n - other < gap:
                            moves.append((abs(gap - 2 * (n - other)), slot, back, n - other))
            if not moves:
                break
            _, slot, back, n = min(moves, key=lambda m: (m[0], m[1], -1 if m[2] is None else m[2]))
            members[low][slot] = members[high].pop(slot)
            owner[slot] = low
            if back is not None:
                members[high][back] = members[low].pop(back)
                owner[back] = high
            total[high] -= n
            total[low] += n
        return SlotMap(self.slots, shards, (*self.versions, tuple(owner)))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(v, slot, shard) for v, owners in enumerate(self.versions) for slot, shard in enumerate(owners)]
        spark.createDataFrame(rows, "version int, slot int, shard int").coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> DataFrame:
        """The newest version as (version, slot, shard): one row per slot."""
        rows = spark.read.parquet(path)
        newest = rows.agg(F.max("version")).first()[0]
        return rows.where(F.col("version") == newest)


def virtual_slot(key: str, text: str, slots: int):
    """The slot of a record: by its key; a record without key goes by its text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))), F.lit(slots)).cast("int")


def shard(docs: DataFrame, shards: int = 16, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``size``, ``virtual_slot``, ``map_version``, ``shard`` and ``slot`` to every record.

    A record's virtual slot depends on its key alone. Bytes are summed per slot (one row per slot goes to
    the driver), the map is edited until the shards hold nearly equal bytes, stored with its versions,
    read back and joined; it is a fixed ``slots`` rows, so it may be broadcast. ``slot`` is the place of
    the record in its shard, without gaps: the records of the shard's earlier slots come first.

    Null texts have no bytes and size 1; repeated rows share a slot and get places of their own; an empty
    table gives no rows. Columns of the input with one of the new names are replaced.
    """
    spark = docs.sparkSession
    new = ["size", "virtual_slot", "map_version", "shard", "slot"]
    rows = docs.drop(*[c for c in docs.columns if c in new and c not in (key, text)])
    rows = rows.withColumns({"size": byte_length(F.col(text)) + 1, "virtual_slot": virtual_slot(key, text, slots)})
    loads = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    plan = SlotMap.first(slots, shards).edited({r.virtual_slot: r.bytes for r in loads})
    path = scratch(spark, "slot-map")
    plan.save(spark, path)
    counts = spark.createDataFrame([(r.virtual_slot, r.n) for r in loads], "virtual_slot int, n long")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    owners = SlotMap.load(spark, path).select(F.col("version").alias("map_version"), F.col("slot").alias("virtual_slot"), "shard")
    owners = owners.join(counts, "virtual_slot").withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("virtual_slot").orderBy(key, "size", F.xxhash64(text))
    placed = rows.join(F.broadcast(owners), "virtual_slot").withColumn("slot", F.col("_before") + F.row_number().over(inside) - 1)
    return placed.select(*[c for c in rows.columns if c not in new], *new)
