"""Joins that keep hot keys apart: time slices for interval joins, partial aggregates first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import dates

_SLICE = "_slice"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
    *,
    unit: str = "minute",
    also: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Equi join plus ``lower <= right_ts - left_ts <= upper`` in whole units.

    Time is cut into slices as wide as the interval, so a left row meets right rows of two
    slices only. Each right row is given to its own and the next slice; the left row stays in
    one. The join key is then (key, slice): a key with very many rows is spread over its
    slices, and left rows without partner survive a left join.
    """
    width = upper - lower + 1
    anchor = F.floor((dates.unit_index(F.col(left_ts), unit) + upper) / width)
    slot = F.floor(dates.unit_index(F.col(right_ts), unit) / width)
    sliced_left = left.withColumn(_SLICE, anchor)
    sliced_right = right.withColumn("_right_slice", F.explode(F.array(slot, slot + 1)))
    match = F.col(_SLICE) == F.col("_right_slice")
    for lk, rk in keys.items():
        match &= F.col(lk) == F.col(rk)
    gap = dates.fn_datetime_diff(unit, F.col(right_ts), F.col(left_ts))
    match &= gap.between(lower, upper)
    if also is not None:
        match &= also
    return sliced_left.join(sliced_right, match, how).drop(_SLICE, "_right_slice")


def interval_join_symmetric(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_ts: str, right_ts: str,
    max_abs: int, unit: str = "hour", how: str = "left",
) -> DataFrame:
    """Rows whose times differ by less than ``max_abs`` units."""
    return interval_join(
        left, right, keys, left_ts, right_ts, 1 - max_abs, max_abs - 1, unit=unit, how=how
    )


def date_range_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_date: str, right_date: str,
    days: int = 3, how: str = "inner",
) -> DataFrame:
    """Rows whose dates lie at most ``days`` apart."""
    return interval_join(left, right, keys, left_date, right_date, -days, days, unit="day", how=how)


def between_join(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], low: Column, high: Column, at: Column, width: int
) -> DataFrame:
    """Inner join on keys and ``low <= at <= high``, for ranges of any length per left row.

    The bounds are whole numbers (``dates.unit_index``). A left row is copied to every slice of
    ``width`` units its range touches; right rows, often with long texts, are not copied.
    """
    ranged = left.withColumns({"_low": low, "_high": high}).where(F.col("_low") <= F.col("_high"))
    slices = F.sequence(F.floor(F.col("_low") / width), F.floor(F.col("_high") / width))
    sliced_left = ranged.withColumn(_SLICE, F.explode(slices))
    sliced_right = right.withColumn("_at", at).withColumn("_right_slice", F.floor(F.col("_at") / width))
    match = (F.col(_SLICE) == F.col("_right_slice")) & F.col("_at").between(F.col("_low"), F.col("_high"))
    for lk, rk in keys.items():
        match &= F.col(lk) == F.col(rk)
    return sliced_left.join(sliced_right, match).drop(_SLICE, "_right_slice", "_low", "_high", "_at")


def left_join_dims(df: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """A chain of left equi joins; ``dims`` holds (table, {df column: table column}).

    No broadcast hint: Spark broadcasts a dimension when its measured size allows, and
    splits hot keys of a sort-merge join at run time otherwise.
    """
    for dim, on in dims:
        renamed = dim.withColumnsRenamed({theirs: f"_dim_{theirs}" for theirs in on.values()})
        match = None
        for ours, theirs in on.items():
            one = F.col(ours) == F.col(f"_dim_{theirs}")
            match = one if match is None else match & one
        df = df.join(renamed, match, "left").drop(*[f"_dim_{t}" for t in on.values()])
    return df


def role_join(df: DataFrame, assign: DataFrame, users: DataFrame, roles: Mapping[str, str], lead: str) -> DataFrame:
    """Name of the person in every role, as one column per role.

    The small tables are joined to each other first, so the wide rows of ``df`` move only once,
    by lead. Several people in a role give several rows, as in a plain left join.
    """
    people = users.select("user_no", "first_nm", "last_nm")
    for name, position in roles.items():
        full = F.concat(F.col("first_nm"), F.lit(" "), F.col("last_nm"))
        role = (
            assign.where(F.col("ja_position") == position)
            .select(F.expr("try_cast(ja_lead as bigint)").alias("_lead"), "ja_user")
            .join(people, F.col("ja_user") == F.col("user_no"), "left")
            .select("_lead", full.alias(name))
        )
        df = df.join(role, F.col(lead) == F.col("_lead"), "left").drop("_lead")
    return df


def join_to_aggregate(df: DataFrame, other: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Left join to the sums of another table; NULL keys do not match."""
    sums = other.groupBy(*keys).agg(*[F.sum(source).alias(new) for new, source in measures.items()])
    return df.join(sums, list(keys), "left")


def semi_join(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return _existence(df, other, on, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return _existence(df, other, on, "left_anti")


def _existence(df, other, on, how):
    side = other.select(*[F.col(theirs).alias(f"_other_{theirs}") for theirs in on.values()])
    match = None
    for ours, theirs in on.items():
        one = F.col(ours) == F.col(f"_other_{theirs}")
        match = one if match is None else match & one
    return df.join(side, match, how)


def semi_join_by(df: DataFrame, other: DataFrame, key: str, on: Mapping[str, str]) -> DataFrame:
    """The rows of ``semi_join``, moved by ``key`` alone, one of the columns of ``on``.

    The rest of the other table's columns is listed once per key, so tables that lie by this key already stay where
    they are. For keys that have few different rows in the other table, as an order has few sites and dates.
    """
    return _existence_by(df, other, key, on, "left_semi")


def anti_join_by(df: DataFrame, other: DataFrame, key: str, on: Mapping[str, str]) -> DataFrame:
    """The rows of ``anti_join``, moved by ``key`` alone as in ``semi_join_by``."""
    return _existence_by(df, other, key, on, "left_anti")


def _existence_by(df, other, key, on, how):
    rest = {ours: theirs for ours, theirs in on.items() if ours != key}
    entry = F.struct(*[F.col(theirs).alias(ours) for ours, theirs in rest.items()])
    listed = other.groupBy(F.col(on[key]).alias("_other_key")).agg(F.collect_set(entry).alias("_listed"))

    def equal(row: Column) -> Column:
        match = F.lit(True)
        for ours in rest:
            match &= F.col(ours) == row[ours]
        return match

    return df.join(listed, (F.col(key) == F.col("_other_key")) & F.exists("_listed", equal), how)
