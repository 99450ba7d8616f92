"""Monthly demand series: preparation, error measures, and per-series forecasts.

A series has one row per month, so a group of ``forecast_fit`` is a few hundred rows at most;
millions of series are fitted in parallel, one task per (series, setting).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY, DS, Y = "series", "ds", "y"


def impute_from_base_year(df: DataFrame, base: int, target: int, months: tuple[int, int]) -> DataFrame:
    """Replace the given months of ``target`` by the values of ``base``; no base row gives NULL."""
    source = df.where(F.col("yr") == base).select(
        F.lit(target).cast("int").alias("_yr"), F.col("mo").alias("_mo"), F.col(KEY).alias("_key"), F.col(Y).alias("_base")
    )
    same = (F.col("yr") == F.col("_yr")) & (F.col("mo") == F.col("_mo")) & (F.col(KEY) == F.col("_key"))
    replaced = (F.col("yr") == target) & F.col("mo").between(*months)
    rows = df.join(source, same, "left").withColumn(Y, F.when(replaced, F.col("_base")).otherwise(F.col(Y)))
    return rows.select(*df.columns)


def train_test_split(df: DataFrame, weeks: int = 26) -> DataFrame:
    """Flag ``is_train``: rows earlier than ``weeks`` before the last date of their series.

    The last dates are aggregated and joined, so a long series is not drawn into one task.
    """
    last = df.groupBy(KEY).agg(F.max(DS).alias("_last"))
    return df.join(last, KEY).withColumn("is_train", F.col(DS) < F.date_sub("_last", 7 * weeks)).drop("_last")


def percentage_error(actual: Column, predicted: Column, mean_actual: Column) -> Column:
    return F.when(actual != 0, (actual - predicted) / actual).otherwise(predicted / mean_actual)


def mape(df: DataFrame, keys: Sequence[str], actual: str = Y, predicted: str = "yhat", out: str = "mape") -> DataFrame:
    """Mean absolute percentage error of |prediction|; a zero actual is measured by the mean actual.

    One aggregation: the errors at zero actuals share the divisor, so it is applied to their sum.
    """
    a, p = F.col(actual), F.abs(F.col(predicted))
    known = df.where(a.isNotNull() & p.isNotNull())
    sums = known.groupBy(*keys).agg(
        F.sum(F.when(a != 0, F.abs((a - p) / a)).otherwise(0.0)).alias("_relative"),
        F.sum(F.when(a == 0, p).otherwise(0.0)).alias("_at_zero"),
        F.avg(a).alias("_mean"), F.count(F.lit(1)).alias("_n"),
    )
    at_zero = F.when(F.col("_at_zero") == 0, 0.0).otherwise(F.try_divide("_at_zero", F.abs("_mean")))
    return sums.select(*keys, ((F.col("_relative") + at_zero) / F.col("_n") * 100).alias(out))


def grid_rows(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the settings, names in alphabetical order, last name varying fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def param_grid(spark: SparkSession, grid: Mapping[str, Sequence]) -> DataFrame:
    """The combinations as a table with ``param_id`` from 1."""
    rows = [{"param_id": i, **row} for i, row in enumerate(grid_rows(grid), 1)]
    return spark.createDataFrame(pd.DataFrame(rows))


def best_params(df: DataFrame, error: str = "test_mape") -> DataFrame:
    """The row with the lowest error per series; the first setting wins ties."""
    rest = [c for c in df.columns if c != KEY]
    rank = F.struct(F.coalesce(F.nanvl(F.col(error), F.lit(None)), F.lit(float("inf"))), F.col("param_id"))
    best = df.groupBy(KEY).agg(F.min_by(F.struct(*rest), rank).alias("_best"))
    return best.select(KEY, "_best.*")


def boxcox_lambda(df: DataFrame, series: str = KEY, y: str = Y, grid: Sequence[float] | None = None, fine: float = 0.001) -> DataFrame:
    """Maximum-likelihood Box-Cox exponent of the positive values per series, as (series, lam, llf).

    All exponents of a grid (of equal steps) are tried in one pass of partial sums, then those of a grid of steps
    ``fine`` around the best. A row stays one row: its values under all exponents are one vector, and the variances of
    the vectors are merged per series. Series without two different values have no exponent. Give it the training part of
    the series (``train_test_split``).
    """
    grid = [round(-2 + i * 0.05, 2) for i in range(81)] if grid is None else list(grid)
    positive = df.where(F.col(y) > 0).select(F.col(series).alias("_of"), F.col(y).cast("double").alias("_x"))
    first = _likeliest(positive, F.lit([float(g) for g in grid]))
    steps = round((grid[1] - grid[0]) / fine) if len(grid) > 1 else 0
    digits = max(0, -math.floor(math.log10(fine)))
    near = positive.join(first.select(F.col("_of").alias("_series"), F.col("lam").alias("_at")), F.col("_of").eqNullSafe(F.col("_series")))
    around = F.transform(F.lit(list(range(-steps, steps + 1))), lambda s: F.round(F.col("_at") + s * fine, digits))
    return _likeliest(near.select("_of", "_x", around.alias("_lams")), F.col("_lams")).withColumnRenamed("_of", series)


def _likeliest(positive: DataFrame, lams: Column) -> DataFrame:
    """(_of, lam, llf) of the likeliest exponent per series; ``lams`` is the same array on all rows of a series."""
    x = F.col("_x")
    changed = F.transform(lams, lambda lam: F.when(lam == 0, F.log(x)).otherwise((F.pow(x, lam) - 1) / F.when(lam != 0, lam)))
    rows = positive.select("_of", lams.alias("_lams"), F.log(x).alias("_log"), array_to_vector(changed).alias("_v"))
    sums = rows.groupBy("_of").agg(
        Summarizer.metrics("variance").summary(F.col("_v")).alias("_s"), F.sum("_log").alias("_logs"), F.count(F.lit(1)).alias("_n"), F.any_value("_lams").alias("_lams"))
    sums = sums.select("_of", "_logs", "_n", "_lams", vector_to_array("_s.variance").alias("_var"))
    spread = lambda v: v * (F.col("_n") - 1) / F.col("_n")
    scored = F.zip_with("_lams", "_var", lambda lam, v: F.when(v > 0, F.struct(
        ((lam - 1) * F.col("_logs") - F.col("_n") / 2 * F.log(spread(v))).alias("llf"), (-lam).alias("_back"), lam.alias("lam"))))
    best = sums.select("_of", F.array_max(F.filter(scored, lambda s: s.isNotNull())).alias("_b"))
    return best.where(F.col("_b").isNotNull()).select("_of", "_b.lam", "_b.llf")


def _nth(year: Column, month: int, weekday: str, n: int) -> Column:
    """The n-th weekday of a month."""
    day_before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(day_before, weekday), 7 * (n - 1))


def holiday_table(years: DataFrame, year: str = "yr", lower: int = 0, upper: int = 6) -> DataFrame:
    """US federal holidays, and their observed days, for the given years."""
    yr = F.col(year).cast("int")

    def fixed_day(month: int, day: int) -> Column:
        return F.make_date(yr, F.lit(month), F.lit(day))

    dated = {
        "New Year's Day": fixed_day(1, 1),
        "Martin Luther King Jr. Day": _nth(yr, 1, "Mon", 3),
        "Washington's Birthday": _nth(yr, 2, "Mon", 3),
        "Memorial Day": F.date_sub(_nth(yr, 6, "Mon", 1), 7),
        "Juneteenth National Independence Day": F.when(yr >= 2021, fixed_day(6, 19)),
        "Independence Day": fixed_day(7, 4),
        "Labor Day": _nth(yr, 9, "Mon", 1),
        "Columbus Day": _nth(yr, 10, "Mon", 2),
        "Veterans Day": fixed_day(11, 11),
        "Thanksgiving": _nth(yr, 11, "Thu", 4),
        "Christmas Day": fixed_day(12, 25),
    }
    listed = F.array(*[F.struct(day.alias(DS), F.lit(name).alias("holiday")) for name, day in dated.items()])
    rows = years.select(year).distinct().select(F.explode(listed).alias("_h")).select("_h.*").where(F.col(DS).isNotNull())
    shift = F.when(F.dayofweek(DS) == 7, -1).when(F.dayofweek(DS) == 1, 1)
    observed = rows.where(shift.isNotNull()).select(
        F.date_add(DS, shift).alias(DS), F.concat("holiday", F.lit(" (Observed)")).alias("holiday")
    )
    return rows.unionByName(observed).select(
        DS, "holiday", F.lit(lower).alias("lower_window"), F.lit(upper).alias("upper_window")
    ).orderBy(DS, "holiday")


def future_frame(df: DataFrame, months: int = 6, fiscal: DataFrame | None = None) -> DataFrame:
    """History dates of every series plus the next month ends, with the columns of ``fiscal``."""
    last = df.groupBy(KEY).agg(F.max(DS).alias("_last"))
    # A last date that is a month end itself starts with the month after.
    first = F.when(F.last_day("_last") == F.col("_last"), F.add_months("_last", 1)).otherwise(F.col("_last"))
    ends = F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_m")
    ahead = last.select(KEY, first.alias("_first"), ends).select(KEY, F.last_day(F.add_months("_first", F.col("_m"))).alias(DS))
    frame = df.select(KEY, DS).unionByName(ahead).distinct()
    return frame if fiscal is None else frame.join(fiscal, DS, "left")


def join_actuals(df: DataFrame, actuals: DataFrame) -> DataFrame:
    return df.join(actuals.select(KEY, DS, Y), [KEY, DS], "left")


# -- the forecast model ---------------------------------------------------------------------

DEFAULT_GRID = {
    "changepoint_prior_scale": [1.0],
    "changepoint_range": [0.8],
    "holidays_prior_scale": [0.8],
    "seasonality_mode": ["multiplicative", "additive"],
}
_DAY = np.timedelta64(1, "D")


def _waves(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(days / period, np.arange(1, order + 1))
    return np.hstack([np.sin(angle), np.cos(angle)])


def _ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)


def fit_series(history: pd.DataFrame, dates: np.ndarray, setting: Mapping, holidays: Mapping, z: float = 1.96) -> pd.DataFrame:
    """Trend with change points plus yearly, 30.5-day and holiday effects, fitted by ridge regression.

    The form of the model is that of Taylor & Letham (2018). ``holidays`` maps names to the days
    (datetime64) on which they act.
    """
    history = history.dropna(subset=["y"]).sort_values("ds")
    seen = history["ds"].to_numpy().astype("datetime64[D]")
    start, span = seen[0], max(int((seen[-1] - seen[0]) / _DAY), 1)
    scale = float(np.abs(history["y"]).max()) or 1.0
    y = history["y"].to_numpy(dtype=float) / scale
    inner = int(len(seen) * float(setting["changepoint_range"]))
    count = max(0, min(25, inner - 1))
    knots = ((seen[np.linspace(0, max(inner - 1, 0), count + 1).round().astype(int)[1:]] - start) / _DAY) / span

    def trend_columns(at: np.ndarray) -> np.ndarray:
        t = ((at - start) / _DAY) / span
        return np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - knots[None, :], 0)])

    names = sorted(holidays)

    def season_columns(at: np.ndarray) -> np.ndarray:
        days = (at - np.datetime64("1970-01-01")) / _DAY
        hits = [np.isin(at, holidays[name]).astype(float)[:, None] for name in names]
        return np.hstack([_waves(days, 365.25, 10), _waves(days, 30.5, 5), *hits])

    noise = 0.05 ** 2
    trend_penalty = np.r_[1e-8, 1e-8, np.full(len(knots), noise / float(setting["changepoint_prior_scale"]) ** 2 * 400)]
    season_penalty = np.r_[np.full(20, noise / 10.0 ** 2 * 400), np.full(10, noise / 0.5 ** 2 * 400),
                           np.full(len(names), noise / float(setting["holidays_prior_scale"]) ** 2 * 400)]
    tx, sx = trend_columns(seen), season_columns(seen)
    dates = np.asarray(dates).astype("datetime64[D]")
    tf, sf = trend_columns(dates), season_columns(dates)
    if setting["seasonality_mode"] == "multiplicative":
        # y = trend * (1 + season): alternate the two linear problems.
        season = np.zeros(len(y))
        for _ in range(5):
            w = 1 + season
            beta = _ridge(tx * w[:, None], y, trend_penalty)
            trend = tx @ beta
            gamma = _ridge(sx * trend[:, None], y - trend, season_penalty)
            season = sx @ gamma
        fitted, yhat = trend * (1 + season), (tf @ beta) * (1 + sf @ gamma)
    else:
        both = _ridge(np.hstack([tx, sx]), y, np.r_[trend_penalty, season_penalty])
        fitted, yhat = np.hstack([tx, sx]) @ both, np.hstack([tf, sf]) @ both
        beta = both[: tx.shape[1]]
    sigma = float(np.std(y - fitted))
    ahead = np.maximum(((dates - seen[-1]) / _DAY) / span, 0)
    slope_change = float(np.mean(np.abs(beta[2:]))) if len(knots) else 0.0
    half = z * np.sqrt(sigma ** 2 + (slope_change * ahead) ** 2)
    return pd.DataFrame({
        "ds": dates, "yhat": yhat * scale, "yhat_lower": (yhat - half) * scale, "yhat_upper": (yhat + half) * scale,
        "trend": (tf @ beta) * scale,
    })


def _holiday_days(holidays: DataFrame | None) -> dict[str, np.ndarray]:
    """Holiday name -> days it acts on; a table of a few rows per year."""
    if holidays is None:
        return {}
    days: dict[str, list] = {}
    for row in holidays.collect():
        for shift in range(row.lower_window, row.upper_window + 1):
            days.setdefault(row.holiday, []).append(np.datetime64(row.ds) + shift)
    return {name: np.asarray(values) for name, values in days.items()}


FORECAST_SCHEMA = (
    "series string, param_id long, ds date, yhat double, yhat_lower double, yhat_upper double, trend double"
)


def forecast_fit(history: DataFrame, frame: DataFrame, grid: Mapping[str, Sequence], holidays: DataFrame | None = None,
                 chosen: DataFrame | None = None) -> DataFrame:
    """Fit every (series, setting) on ``history`` and predict the dates of ``frame``.

    ``history`` has series, ds, y; ``frame`` has series, ds. Duplicate months are averaged first,
    which bounds every group by the number of months. With ``chosen`` (series, param_id) only those
    settings are fitted.
    """
    settings = {i: row for i, row in enumerate(grid_rows(grid), 1)}
    acting = _holiday_days(holidays)
    known = history.groupBy(KEY, DS).agg(F.avg(Y).alias(Y))
    rows = frame.select(KEY, DS).distinct().join(known, [KEY, DS], "full").join(
        frame.select(KEY, DS).distinct().withColumn("_wanted", F.lit(True)), [KEY, DS], "left"
    )
    spread = rows.select("*", F.explode(F.array(*[F.lit(i) for i in settings])).alias("param_id"))
    if chosen is not None:
        spread = rows.join(chosen.select(KEY, F.col("param_id").cast("int").alias("param_id")), KEY)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        series, param = group[KEY].iloc[0], int(group["param_id"].iloc[0])
        group = group.assign(ds=pd.to_datetime(group["ds"]))
        past = group[group["y"].notna()][["ds", "y"]]
        wanted = np.sort(group[group["_wanted"].notna()]["ds"].unique())
        if past.empty:
            return pd.DataFrame({"series": [], "param_id": [], "ds": [], "yhat": [], "yhat_lower": [], "yhat_upper": [], "trend": []})
        result = fit_series(past, wanted, settings[param], acting)
        result.insert(0, "series", series)
        result.insert(1, "param_id", param)
        return result

    return spread.groupBy(KEY, "param_id").applyInPandas(fit, FORECAST_SCHEMA)


def tune_models(df: DataFrame, grid: Mapping[str, Sequence], holidays: DataFrame | None = None, weeks: int = 26) -> DataFrame:
    """Train and test error of every (series, setting): series, param_id, train_mape, test_mape."""
    split = train_test_split(df, weeks)
    predicted = forecast_fit(split.where("is_train"), df, grid, holidays)
    both = predicted.join(split.select(KEY, DS, Y, "is_train"), [KEY, DS])
    keys = [KEY, "param_id"]
    train = mape(both.where("is_train"), keys, out="train_mape")
    test = mape(both.where("not is_train"), keys, out="test_mape")
    return train.join(test, keys, "full")


def forecast_output(predicted: DataFrame, actuals: DataFrame) -> DataFrame:
    """series, ds, yhat (never negative) and the actual value where there is one."""
    rows = join_actuals(predicted, actuals).where(F.col(KEY) != "0")
    return rows.select(KEY, DS, F.greatest(F.col("yhat"), F.lit(0.0)).alias("yhat"), Y)
