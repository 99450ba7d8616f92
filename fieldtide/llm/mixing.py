"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtide.llm.common import stored, word_count

BLOCK_ROWS = 4_000   # expected rows of a block at the leaves of the reduction tree
FAN_IN = 64          # residuals that one node of the tree combines
MOST = 3             # no source's target and no document's copies exceed this many times its size


def targets(sizes: DataFrame, source: str = "source", most: int = MOST) -> DataFrame:
    """(source, rank, docs, source_size, target): one row per source.

    Sources in code-point order (null last) weigh 1, 2, 3, repeating. All words are shared by weight; a target
    stops at ``most`` times its source and the excess is shared again. That ends with target = min(cap, x * weight)
    for one x, found on the sources in order of cap / weight.
    """
    per = sizes.groupBy(source).agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    # One row per source from here on, so windows without partition are small.
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())))
    ranked = ranked.withColumns({"_w": ((F.col("rank") - 1) % 3 + 1).cast("double"), "_cap": F.col("source_size") * float(most)})
    line = Window.orderBy(F.col("_cap") / F.col("_w"), "rank")
    earlier, later = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    shared = ranked.withColumn("_x", left / F.sum("_w").over(later))
    open_x = F.min(F.when(F.col("_x") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "rank", "_x"))).over(Window.partitionBy())
    target = F.least(F.col("_cap"), F.coalesce(open_x["_x"] * F.col("_w"), F.col("_cap")))
    return shared.select(source, "rank", "docs", "source_size", target.alias("target"))


def _fights(rows: pd.DataFrame) -> pd.DataFrame:
    """Pair the records of one node, largest first, and move mass until all but one, a small one, are decided.

    Of a pair with p + q < 1 one record gets all of the mass and the other none; else one gets a whole copy and
    the other the rest. Each record keeps its expected number of copies. ``extra`` is the decision, ``p`` of the
    one record left the mass it carries to the next node.
    """
    rows = rows.sort_values([c for c in ("size", "key", "u", "hash", "row") if c in rows], ascending=False, kind="stable", ignore_index=True)
    p, u = rows["p"].to_list(), rows["u"].to_list()
    extra: list = [None] * len(p)
    held = None
    for i in range(len(p)):
        if p[i] <= 1e-12 or p[i] >= 1 - 1e-12:
            extra[i], p[i] = int(p[i] > 0.5), 0.0
        elif held is None:
            held = i
        else:
            a, b = p[held], p[i]
            both = a + b
            if both < 1:
                loser = held if u[i] * both >= a else i
                winner = i if loser == held else held
                extra[loser], p[loser], p[winner] = 0, 0.0, both
                held = winner
            else:
                # The record that keeps the rest instead of a whole copy.
                winner = held if u[i] * (2 - both) < 1 - b else i
                other = i if winner == held else held
                extra[winner], p[winner], p[other] = 1, 0.0, both - 1
                held = other
            if p[held] <= 1e-12 or p[held] >= 1 - 1e-12:
                extra[held], p[held] = int(p[held] > 0.5), 0.0
                held = None
    rows["p"], rows["extra"] = p, pd.array(extra, dtype="Int32")
    return rows


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 17,
        row: str | None = None) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every row: how often the mix takes it.

    The copies of a document are target / source_size, a whole part for certain and a fraction that is rounded by
    pivotal dependent rounding: records fight in pairs, neighbours in size first, so the words taken stay near the
    target; each block leaves one record with a fraction, and these meet in a tree of FAN_IN residuals a node. Blocks
    are cut by a hash of the key, as many as the source's rows need, so a hot source is split and no task holds one.
    All draws are hashes of key and seed: reruns agree. A null text has size 0 and is taken with copies that add no words;
    a source without words has target 0; repeated rows count and are drawn each for itself; an empty table gives no rows.
    A column ``row`` that numbers the rows is kept, so the copies can be joined row by row.
    """
    own = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                      F.xxhash64(text).alias("hash"), (F.col(row) if row else F.lit(0)).cast("long").alias("row"))
    sizes = stored(own, "mix-sizes")
    per = stored(targets(sizes), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_ROWS)).cast("long")
    rows = sizes.join(per, sizes["source"].eqNullSafe(per["source"])).select(
        "key", sizes["source"], "rank", "size", "source_size", "target", F.floor(copies).cast("int").alias("whole"),
        (copies - F.floor(copies)).alias("p"), F.pmod(F.xxhash64("key", F.lit(seed)), blocks).alias("block"),
        ((F.xxhash64(F.lit(seed), "key").bitwiseAND(F.lit((1 << 53) - 1))) / float(1 << 53)).alias("u"), "hash", "row",
    )
    schema = rows.withColumn("extra", F.lit(None).cast("int")).schema
    most = per.agg(F.max(F.ceil(F.col("docs") / BLOCK_ROWS))).first()[0] or 1
    done = None
    while True:
        level = stored(rows.groupBy("rank", "block").applyInPandas(_fights, schema), "mix-level")
        decided = level.where("extra is not null")
        done = decided if done is None else done.unionByName(decided)
        left = level.where("extra is null").drop("extra")
        if most <= 1:
            break
        rows = left.withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
        most = -(-most // FAN_IN)
    # The one record left of each source.
    done = done.unionByName(left.withColumn("extra", (F.col("u") < F.col("p")).cast("int")))
    taken = F.col("whole") + F.col("extra")
    return done.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.alias("copies"),
        (taken * F.col("size")).cast("long").alias("taken"), *([F.col("row").alias(row)] if row else []),
    )
