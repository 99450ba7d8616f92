"""Monthly appointment forecast from files to the output table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.operators import timeseries as ts
from fieldtide.session import stored
from fieldtide.sources import sinks, tables

HISTORY = "yr int, mo int, ds date, y double, series string, qtr int, moq int"
FUTURE = "yr int, mo int, ds date, qtr int, moq int"


def chosen_settings(filled: DataFrame, grid: Mapping[str, Sequence], holidays: DataFrame) -> DataFrame:
    """(series, param_id, parameters, train_mape, test_mape): the best setting of every series, its values as JSON."""
    named = filled.sparkSession.createDataFrame(
        [(i, json.dumps(row, sort_keys=True)) for i, row in enumerate(ts.grid_rows(grid), 1)], "param_id long, parameters string")
    best = ts.best_params(ts.tune_models(filled, grid, holidays))
    return best.join(F.broadcast(named), "param_id").select(ts.KEY, "param_id", "parameters", "train_mape", "test_mape")


def appointment_forecast(
    series: DataFrame, base: int, target: int, months: tuple[int, int],
    grid: Mapping[str, Sequence] = ts.DEFAULT_GRID, horizon: int = 6, settings: DataFrame | None = None,
) -> DataFrame:
    """Impute, tune every series, refit the best setting on the whole history, predict ahead.

    With ``settings`` (series, param_id) of an earlier run nothing is tuned. The series and the frame are stored when this
    is called.
    """
    # Both are read by every later step.
    filled = stored(ts.impute_from_base_year(series, base, target, months), "series")
    frame = stored(ts.future_frame(filled, horizon), "frame")
    holidays = ts.holiday_table(frame.select(F.year(ts.DS).alias("yr")))
    best = chosen_settings(filled, grid, holidays) if settings is None else settings
    predicted = ts.forecast_fit(filled, frame, grid, holidays, best.select(ts.KEY, "param_id"))
    return ts.forecast_output(predicted, filled)


def forecast_from_files(
    spark: SparkSession, history: str, future: str, out: str, base: int, target: int, months: tuple[int, int],
    grid: Mapping[str, Sequence] = ts.DEFAULT_GRID, horizon: int = 6, tune: bool = True,
) -> DataFrame:
    """The whole job: read the history (seven columns) and the future calendar (five columns) of files without a header,
    and write ``<out>/settings`` and ``<out>/forecast`` (series, ds, yhat, y, and the calendar's columns where it knows
    the date). Returns the forecast as read back.

    Without ``tune`` the settings saved by an earlier run are used; series that it did not know are left out.
    """
    rows = tables.read_headerless_csv(spark, history, HISTORY)
    known = tables.read_headerless_csv(spark, future, FUTURE)
    filled = stored(ts.impute_from_base_year(rows, base, target, months), "series")
    if tune:
        dates = ts.future_frame(filled, horizon).select(F.year(ts.DS).alias("yr"))
        settings = sinks.write_overwrite(chosen_settings(filled, grid, ts.holiday_table(dates)), f"{out}/settings")
    else:
        settings = spark.read.parquet(f"{out}/settings")
    predicted = appointment_forecast(filled, base, target, months, grid, horizon, settings)
    calendar = known.select(ts.DS, "yr", "mo", "qtr", "moq").dropDuplicates([ts.DS])
    return sinks.write_overwrite(predicted.join(calendar, ts.DS, "left"), f"{out}/forecast")
