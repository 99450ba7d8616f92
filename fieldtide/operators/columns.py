"""Projections and filters on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import fixed_values as fixed


def project_star_plus(df: DataFrame, exprs: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """All columns but ``drop``, plus computed ones."""
    return df.withColumns(dict(exprs)).drop(*drop)


def rename_columns(df: DataFrame, names: Mapping[str, str] | Sequence[str] | DataFrame) -> DataFrame:
    """Rename by name (mapping), by position (sequence) or to the header of another table."""
    if isinstance(names, Mapping):
        return df.withColumnsRenamed(dict(names))
    if isinstance(names, DataFrame):
        names = names.columns
    return df.toDF(*names)


def drop_all_null(df: DataFrame, data_cols: Sequence[str]) -> DataFrame:
    """Rows where at least one of the data columns has a value."""
    return df.dropna("all", subset=list(data_cols))


def current_version(df: DataFrame, end_col: str, open_end: str = fixed.OPEN_END) -> DataFrame:
    """Rows of a history table that are still open."""
    return df.where(F.to_date(F.col(end_col)) == F.lit(open_end).cast("date"))


def filter_predicates(df: DataFrame, *conditions: Column) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def filter_single_series(df: DataFrame, series: object, series_col: str = "series") -> DataFrame:
    return df.where(F.col(series_col) == series)


def dynamic_distinct_list(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
