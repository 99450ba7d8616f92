"""Row numbers, running sums and previous-row values inside a key, for keys of any size.

One plan serves every key: rows are range-partitioned by (key, order), so a key of a third of all
rows covers many blocks. Each block computes its own part, and a key that goes on over a block's
edge takes the totals of its earlier blocks. Only the first and the last key of a block can do
that, so those totals are two rows per block, whatever the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtide.session import stored

_AT, _BLOCK, _LOCAL = "_at", "_block", "_local_n"
_ROW_BITS = 33  # monotonically_increasing_id() holds the partition above these bits and the row in it below


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    number: str = "ord",
    reverse: str | None = None,
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add a row number per key and, on request, more columns that need the same order.

    ``order`` must be total inside a key. ``reverse`` numbers from the end; ``sums`` maps new
    columns to the value they accumulate (ROWS frame, current row included; NULL until there is a
    value); ``previous`` maps new columns to the column whose value on the preceding row they hold.
    Without ``keys`` the whole input is one sequence. The sorted rows are stored once, so that the
    blocks stay as they are if an executor is lost.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.repartitionByRange(blocks, *[F.col(k) for k in keys], *order).sortWithinPartitions(*[F.col(k) for k in keys], *order)
    ranged = stored(sorted_rows.withColumn(_AT, F.monotonically_increasing_id()), "ordered")
    ranged = ranged.withColumn(_BLOCK, F.shiftright(_AT, _ROW_BITS))
    edges = _edges(ranged, list(keys), sums, previous)
    if not keys and not sums and not previous:
        # The place in the block is known already: nothing is shuffled again.
        local = ranged.withColumn(_LOCAL, F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)
        size = F.col("_n")
    else:
        inside = Window.partitionBy(_BLOCK, *keys).orderBy(_AT)
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = ranged.select(
            "*", F.row_number().over(inside).alias(_LOCAL),
            *([F.count(F.lit(1)).over(Window.partitionBy(_BLOCK, *keys)).alias("_here")] if reverse else []),
            *[F.sum(v).over(upto).alias(f"_run_{n}") for n, v in sums.items()],
            *[F.lag(v).over(inside).alias(f"_lag_{n}") for n, v in previous.items()],
        )
        size = F.col("_here")
    match = F.col(_BLOCK) == F.col("_b")
    for i, key in enumerate(keys):
        match &= F.col(key).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(edges), match, "left")
    before = F.coalesce("_before", F.lit(0))
    added = {number: before + F.col(_LOCAL)}
    if reverse:
        added[reverse] = size - F.col(_LOCAL) + 1 + F.coalesce("_after", F.lit(0))
    for n in sums:
        run, off = F.col(f"_run_{n}"), F.col(f"_off_{n}")
        added[n] = F.coalesce(off + run, run, off)
    for n in previous:
        added[n] = F.when((F.col(_LOCAL) == 1) & (before > 0), F.col(f"_last_{n}")).otherwise(F.col(f"_lag_{n}"))
    return joined.select(*df.columns, *[column.alias(new) for new, column in added.items()])


def _edges(ranged: DataFrame, keys: list[str], sums: Mapping[str, str], previous: Mapping[str, str]) -> DataFrame:
    """What a key that spans blocks has in its earlier and later blocks: at most two rows per block."""
    totals = ranged.groupBy(*keys, _BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_sum_{n}") for n, v in sums.items()],
        *([F.max_by(F.struct(*[F.col(v).alias(f"_p_{n}") for n, v in previous.items()]), _AT).alias("_tail")] if previous else []),
    )
    line = Window.partitionBy(*keys).orderBy(_BLOCK)
    earlier, later = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    rows = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(_BLOCK).alias("_b"), "_n",
        F.sum("_n").over(earlier).alias("_before"), F.sum("_n").over(later).alias("_after"),
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_off_{n}") for n in sums],
        *[F.lag(F.col("_tail")[f"_p_{n}"]).over(line).alias(f"_last_{n}") for n in previous],
    )
    return rows.where(F.col("_before").isNotNull() | F.col("_after").isNotNull()) if keys else rows


def chunk_numbers(df: DataFrame, order: Sequence[Column], size: int = 1999) -> DataFrame:
    """Number all rows in the given total order and put every ``size`` of them in one chunk."""
    rows = numbered(df, [], order, number="row_no")
    return rows.withColumn("chunk_no", F.ceil(F.col("row_no") / size))
