"""Monthly series: preparation, errors, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtide.adapters import Tables
from fieldtide.operators import timeseries as ts
from fieldtide.plans.forecast import appointment_forecast, forecast_from_files
from fieldtide.registry.core import query
from fieldtide.registry.forecast_sql import fit_sql, holidays_sql, tune_sql
from fieldtide.session import scratch_path


def series(t: Tables):
    return t.fx("fx_series")


IMPUTED_SQL = """imp as (select a.* replace (case when a.yr = 2000 and a.mo between 3 and 4 then b.y else a.y end as y) from fx_series a
 left join fx_series b on b.yr = 1999 and a.yr = 2000 and b.mo = a.mo and b.series = a.series)"""


@query("impute_from_base_year", IMPUTED_SQL + "---select * from imp", views=["fx_series"], texts=["ds"])
def impute(t):
    return ts.impute_from_base_year(series(t), 1999, 2000, (3, 4))


@query("train_test_split", "select series, ds, y, ds < max(ds) over (partition by series) - 182 is_train from fx_series", views=["fx_series"], texts=["ds"])
def split(t):
    return ts.train_test_split(series(t)).select("series", "ds", "y", "is_train")


ERR = "case when mo = 1 then 0 else y end"


@query("mape", f"""e as (select series, {ERR} a, abs(y * 1.1 - mo) p, avg({ERR}) over (partition by series) m from fx_series)
---select series, avg(abs(case when a <> 0 then (a - p) / a else p / m end)) * 100 mape from e group by 1""", views=["fx_series"], digits={"mape": 6})
def mape(t):
    actual = F.when(F.col("mo") == 1, 0).otherwise(F.col("y"))
    rows = series(t).withColumns({"yhat": F.col("y") * 1.1 - F.col("mo"), "y": actual})
    return ts.mape(rows, ["series"])


@query("best_params", """e as (select series, mo param_id, round(stddev_pop(y) / avg(y), 6) test_mape from fx_series group by 1, 2)
---select series, param_id, test_mape from (select *, row_number() over (partition by series order by test_mape nulls last, param_id) n from e) x where n = 1""",
       views=["fx_series"])
def best(t):
    error = F.round(F.stddev_pop("y") / F.avg("y"), 6).alias("test_mape")
    return ts.best_params(series(t).groupBy("series", F.col("mo").alias("param_id")).agg(error))


GRID = ", ".join(f"({round(-2 + i * 0.05, 2)}::double)" for i in range(81))


def likelihood_sql(name: str, source: str) -> str:
    return f"""{name} as (select series, lam, (lam - 1) * sum(ln(y)) - count(*) / 2.0 * ln(var_pop(case when lam = 0 then ln(y) else (pow(y, lam) - 1) / nullif(lam, 0) end)) llf
 from {source} group by 1, 2)"""


@query("boxcox_lambda", f"""g as (select * from (values {GRID}) v(lam)),
train as (select series, y from (select *, max(ds) over (partition by series) last from fx_series) x where ds < last - 182 and y > 0),
{likelihood_sql('l', '(select * from train, g) x')}, b as (select series, arg_max(lam, llf) lam from l group by 1),
{likelihood_sql('f', '(select train.series, y, round(b.lam + s * 0.001, 3) lam from train join b using (series), (select unnest(range(-50, 51)) s) r) x')}
---select series, arg_max(lam, llf) lam, max(llf) llf from f group by 1""", views=["fx_series"], digits={"llf": 5, "lam": 3})
def boxcox(t):
    return ts.boxcox_lambda(ts.train_test_split(series(t)).where("is_train"))


@query("param_grid", """select distinct series, p.* from fx_series, (values (1, 1.0::double, 0.8::double, 0.8::double, 'multiplicative'),
 (2, 1.0, 0.8, 0.8, 'additive')) p(param_id, changepoint_prior_scale, changepoint_range, holidays_prior_scale, seasonality_mode)""", views=["fx_series"])
def grid(t):
    table = ts.param_grid(t.spark, ts.DEFAULT_GRID)
    ids = F.explode(F.array(*[F.lit(i).cast("long") for i in range(1, len(ts.grid_rows(ts.DEFAULT_GRID)) + 1)]))
    listed = series(t).select("series").distinct().select("series", ids.alias("param_id"))
    return listed.join(F.broadcast(table), "param_id")


HOLIDAYS_SQL = """years as (select distinct year(o_orderdate)::int y from orders),
firsts as (select y, m, make_date(y, m, 1) f from years, (values (1), (2), (6), (9), (10), (11)) v(m)),
nth as (select y, m, f + ((1 - dayofweek(f) + 7) % 7)::int mon, f + ((4 - dayofweek(f) + 7) % 7)::int thu from firsts),
base as (select make_date(y, 1, 1) ds, 'New Year''s Day' holiday from years
 union all select mon + 14, 'Martin Luther King Jr. Day' from nth where m = 1
 union all select mon + 14, 'Washington''s Birthday' from nth where m = 2
 union all select mon - 7, 'Memorial Day' from nth where m = 6
 union all select make_date(y, 6, 19), 'Juneteenth National Independence Day' from years where y >= 2021
 union all select make_date(y, 7, 4), 'Independence Day' from years
 union all select mon, 'Labor Day' from nth where m = 9
 union all select mon + 7, 'Columbus Day' from nth where m = 10
 union all select make_date(y, 11, 11), 'Veterans Day' from years
 union all select thu + 21, 'Thanksgiving' from nth where m = 11
 union all select make_date(y, 12, 25), 'Christmas Day' from years)
---select *, 0 lower_window, 6 upper_window from (select * from base union all
 select ds + case when dayofweek(ds) = 6 then -1 else 1 end, holiday || ' (Observed)' from base where dayofweek(ds) in (0, 6)) h"""


@query("holiday_table", HOLIDAYS_SQL, texts=["ds"])
def holidays(t):
    return ts.holiday_table(t.table("orders").select(F.year("o_orderdate").alias("yr")))


FRAME_SQL = """last as (select series, max(ds) l from fx_series group by 1),
frame as (select series, ds from fx_series union
 select series, last_day(case when last_day(l) = l then l + interval 1 month else l end + to_months(m)) from last, (select unnest(range(6))::int m) r)"""


@query("future_frame", FRAME_SQL + """, fis as (select distinct ds, month(ds) fiscal_month from fx_series)
---select f.series, f.ds, fiscal_month from frame f left join fis using (ds)""", views=["fx_series"], texts=["ds"])
def frame(t):
    fiscal = series(t).select("ds", F.month("ds").cast("long").alias("fiscal_month")).distinct()
    return ts.future_frame(series(t), 6, fiscal).select("series", "ds", "fiscal_month")


@query("join_actuals", FRAME_SQL + "---select f.series, f.ds, s.y from frame f left join fx_series s on s.series = f.series and s.ds = f.ds", views=["fx_series"], texts=["ds"])
def actuals(t):
    return ts.join_actuals(ts.future_frame(series(t)), series(t)).select("series", "ds", "y")


@query("forecast_output", FRAME_SQL + """---select f.series, f.ds, greatest(month(f.ds) * 10.0 - 60, 0) yhat, s.y
 from frame f left join fx_series s on s.series = f.series and s.ds = f.ds""", views=["fx_series"], texts=["ds"], digits={"yhat": 4})
def output(t):
    predicted = ts.future_frame(series(t)).withColumn("yhat", F.month("ds") * 10.0 - 60)
    return ts.forecast_output(predicted, series(t))


def _holidays(t):
    return ts.holiday_table(series(t).select("yr"))


SETTINGS_SQL = "p as (select unnest([1, 2])::bigint param_id)"
FITTED = {"yhat": 4, "yhat_lower": 4, "yhat_upper": 4, "trend": 4}
FIT_SQL = FRAME_SQL + ", " + holidays_sql(HOLIDAYS_SQL, "fx_series") + ", " + fit_sql("fits", "fx_series", "frame") + "---select * from fits"


@query("forecast_fit_rows", FRAME_SQL + f""", {SETTINGS_SQL}
---select distinct series, param_id, ds, true ordered from frame, p where series is not null""", views=["fx_series"], texts=["ds"])
def fit_rows(t):
    """Every series, setting and date once, with the prediction inside its bounds."""
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return fit(t).select("series", "param_id", "ds", ordered.alias("ordered"))


@query("tune_models_rows", f"{SETTINGS_SQL}---select distinct series, param_id, true measured from fx_series, p", views=["fx_series"])
def tune_rows(t):
    measured = (F.col("train_mape") >= 0) & (F.col("test_mape") >= 0)
    return tune(t).select("series", "param_id", measured.alias("measured"))


@query("appointment_forecast_rows", FRAME_SQL + "---select f.series, f.ds, true positive from frame f", views=["fx_series"], texts=["ds"])
def forecast_rows(t):
    """One row per series and date, none of them negative."""
    return forecast(t).select("series", "ds", (F.col("yhat") >= 0).alias("positive"))


@query("forecast_fit", FIT_SQL, views=["fx_series"], texts=["ds"], digits=FITTED, recursive=True)
def fit(t):
    rows = series(t)
    return ts.forecast_fit(rows, ts.future_frame(rows), ts.DEFAULT_GRID, _holidays(t))


TUNE_SQL = holidays_sql(HOLIDAYS_SQL, "fx_series") + ", " + tune_sql("tuned", "fx_series") + "---select * from tuned"


@query("tune_models", TUNE_SQL, views=["fx_series"], digits={"train_mape": 4, "test_mape": 4}, recursive=True)
def tune(t):
    return ts.tune_models(series(t), ts.DEFAULT_GRID, _holidays(t))


# Imputed, tuned, the better setting fitted again on everything, the future added, negative values cut.
FORECAST_SQL = (
    IMPUTED_SQL + ", filled as materialized (select series, ds, y from imp), " + FRAME_SQL.replace("fx_series", "filled") + ", "
    + holidays_sql(HOLIDAYS_SQL, "frame") + ", " + tune_sql("tuned", "filled") + """,
chosen as (select series, arg_min(param_id, {'e': coalesce(test_mape, 'inf'::double), 'p': param_id}) param_id from tuned group by 1), """
    + fit_sql("fits", "filled", "frame") + """
---select f.series, f.ds, greatest(yhat, 0) yhat, s.y from fits f join chosen c on c.series = f.series and c.param_id = f.param_id
 left join filled s on s.series = f.series and s.ds = f.ds where f.series <> '0'""")


@query("appointment_forecast", FORECAST_SQL, views=["fx_series"], texts=["ds"], digits={"yhat": 4}, recursive=True)
def forecast(t):
    return appointment_forecast(series(t), 1999, 2000, (3, 4))


@query("appointment_forecast_files", FORECAST_SQL.replace("greatest(yhat, 0) yhat, s.y", """greatest(yhat, 0) yhat, s.y, case when f.ds = last_day(f.ds) then quarter(f.ds)::int end qtr"""),
       views=["fx_series"], texts=["ds"], digits={"yhat": 4}, recursive=True)
def forecast_files(t):
    """From headerless files to saved tables, then once more with the saved settings; the calendar lists the month ends ahead."""
    history, future, out = (scratch_path(t.spark, n) for n in ("history", "future", "forecast"))
    rows = series(t)
    rows.select("yr", "mo", "ds", "y", "series", F.quarter("ds").alias("qtr"), ((F.col("mo") - 1) % 3 + 1).alias("moq")).write.csv(history)
    ahead = ts.future_frame(rows).select("ds").where(F.col("ds") == F.last_day("ds")).distinct()
    ahead.select(F.year("ds"), F.month("ds"), "ds", F.quarter("ds"), (F.month("ds") - 1) % 3 + 1).write.csv(future)
    forecast_from_files(t.spark, history, future, out, 1999, 2000, (3, 4))
    again = forecast_from_files(t.spark, history, future, out, 1999, 2000, (3, 4), tune=False)
    return again.select("series", "ds", "yhat", F.col("y").cast("long").alias("y"), "qtr")
