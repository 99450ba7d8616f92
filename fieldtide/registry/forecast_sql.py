"""The forecast model in SQL: design rows, normal equations, and their solution by elimination."""

from __future__ import annotations

EPOCH = "date '1970-01-01'"
NOISE = 0.05 ** 2 * 400


def waves_sql(period: float, order: int) -> str:
    angles = [f"2 * pi() * (({{days}} / {period}::double) * {j})" for j in range(1, order + 1)]
    return ", ".join([f"sin({a})" for a in angles] + [f"cos({a})" for a in angles])


def solved(name: str, rows: str, penalty: str) -> str:
    """``name``(series, beta): minimum of |y - x beta|^2 + penalty over ``rows``(series, x, y), by Gauss and Jordan.

    ``penalty`` is a query of (series, pen).
    """
    return f"""{name}_cells as materialized (select series, i, j, sum(v) v from (
  select series, i, unnest(range(1, len(x) + 1)) j, x[i] * unnest(x) v from (select series, x, unnest(range(1, len(x) + 1)) i from {rows}) a) b group by 1, 2, 3),
{name}_right as materialized (select series, i, sum(v) b from (select series, unnest(range(1, len(x) + 1)) i, unnest(x) * y v from {rows}) a group by 1, 2),
{name}_start as materialized (select c.series, c.i, list(c.v + case when c.i = c.j then pen[c.i] else 0 end order by c.j) || [any_value(b)] w
 from {name}_cells c join ({penalty}) p using (series) join {name}_right r on r.series = c.series and r.i = c.i group by 1, 2),
{name}_steps as (select series, 0 k, i, w from {name}_start
 union all select a.series, a.k + 1, a.i, case when a.i = a.k + 1 then list_transform(p.w, lambda v: v / p.w[a.k + 1])
  else list_transform(list_zip(a.w, p.w), lambda z: z[1] - a.w[a.k + 1] / p.w[a.k + 1] * z[2]) end
 from {name}_steps a join {name}_steps p on p.series = a.series and p.i = a.k + 1 where a.k < len(a.w) - 1),
{name} as materialized (select series, list(w[-1] order by i) beta from {name}_steps where k = len(w) - 1 group by 1)"""


def fit_sql(name: str, history: str, frame: str) -> str:
    """``name``(series, param_id, ds, yhat, yhat_lower, yhat_upper, trend) for both settings of the default grid.

    ``history`` has (series, ds, y), ``frame`` (series, ds); the holidays are those of ``holiday_days``(ds, name).
    """
    n = name
    dated = f"""(s.ds - f.start) / f.span::double"""
    features = f"""[1.0::double, t] || list_transform(knots, lambda c: greatest(t - c, 0.0::double)) tr,
  [{waves_sql(365.25, 10).format(days='dd')}, {waves_sql(30.5, 5).format(days='dd')}]::double[] || hits se"""
    hits = "(select d.ds, list((h.ds is not null)::int::double order by names.name) hits from (select distinct ds from {src}) d cross join (select distinct name from holiday_days) names left join (select distinct ds, name from holiday_days) h on h.ds = d.ds and h.name = names.name group by 1)"

    def design(src: str, extra: str) -> str:
        return f"""(select series, ds, {extra} {features} from (select f.*, s.ds, {extra} {dated} t, (s.ds - {EPOCH})::double dd, hits
  from {src} s join {n}_fit f using (series) join {hits.format(src=src)} x on x.ds = s.ds) q)"""

    parts = [f"""{n}_known as materialized (select series, ds, avg(y)::double y from {history} where y is not null group by 1, 2),
{n}_stats as (select series, min(ds) start, max(ds) last, greatest(max(ds) - min(ds), 1) span, case when max(abs(y)) = 0 then 1 else max(abs(y)) end scale,
  count(*) n, greatest(floor(count(*) * 0.8)::int, 0) inside from {n}_known group by 1),
{n}_counts as (select *, greatest(0, least(25, inside - 1)) knots_n from {n}_stats),
{n}_at as (select series, unnest(range(1, knots_n + 1)) i, inside, knots_n from {n}_counts),
{n}_places as (select series, i, round_even(i * (greatest(inside - 1, 0) / knots_n), 0)::bigint place from {n}_at),
{n}_numbers as (select series, ds, row_number() over (partition by series order by ds) - 1 place from {n}_known),
{n}_knots as (select series, list((ds - start) / span::double order by i) knots from {n}_places join {n}_numbers using (series, place) join {n}_counts using (series) group by 1),
{n}_fit as materialized (select c.*, coalesce(knots, []) knots from {n}_counts c left join {n}_knots using (series)),
{n}_past as materialized (select d.*, y / scale y from {design(f'{n}_known', '')} d join {n}_known using (series, ds) join {n}_fit using (series)),
{n}_ahead as materialized {design(f'(select distinct series, ds from {frame})', '')},
{n}_pt as (select series, [1e-8, 1e-8] || list_transform(knots, lambda c: {NOISE}) pen from {n}_fit),
{n}_ps as (select series, list_transform(range(20), lambda i: {NOISE / 100.0}) || list_transform(range(10), lambda i: {NOISE / 0.25})
  || list_transform(range((select count(distinct name) from holiday_days)), lambda i: {NOISE} / {0.8 ** 2}) pen from {n}_fit)"""]
    dot = lambda a, b: f"list_dot_product({a}, {b})"
    # Additive: one system of both parts.
    parts.append(solved(f"{n}_add", f"(select series, tr || se x, y from {n}_past) z", f"select t.series, t.pen || s.pen pen from {n}_pt t join {n}_ps s using (series)"))
    parts.append(f"""{n}_fitted2 as (select series, ds, y, {dot('tr || se', 'beta')} f from {n}_past join {n}_add using (series)),
{n}_pred2 as (select series, ds, {dot('tr || se', 'beta')} yhat, {dot('tr', 'beta[:len(tr)]')} trend, beta[:len(tr)] beta from {n}_ahead join {n}_add using (series))""")
    # Multiplicative: trend and season in turn.
    season = "0.0::double"
    for step in range(5):
        source = f"{n}_past" if step == 0 else f"{n}_past join {n}_s{step - 1} g using (series)"
        season = "0.0::double" if step == 0 else dot("se", "g.beta")
        parts.append(f"{n}_w{step} as materialized (select series, ds, y, tr, se, 1 + {season} w from {source})")
        parts.append(solved(f"{n}_t{step}", f"(select series, list_transform(tr, lambda v: v * w) x, y from {n}_w{step}) z", f"select series, pen from {n}_pt"))
        parts.append(f"{n}_v{step} as materialized (select series, y, se, {dot('tr', 'beta')} trend from {n}_w{step} join {n}_t{step} using (series))")
        parts.append(solved(f"{n}_s{step}", f"(select series, list_transform(se, lambda v: v * trend) x, y - trend y from {n}_v{step}) z", f"select series, pen from {n}_ps"))
    parts.append(f"""{n}_fitted1 as (select series, ds, y, {dot('tr', 'b.beta')} * (1 + {dot('se', 'g.beta')}) f from {n}_past join {n}_t4 b using (series) join {n}_s4 g using (series)),
{n}_pred1 as (select series, ds, {dot('tr', 'b.beta')} * (1 + {dot('se', 'g.beta')}) yhat, {dot('tr', 'b.beta')} trend, b.beta beta
 from {n}_ahead join {n}_t4 b using (series) join {n}_s4 g using (series)),
{n}_sigma as (select series, 1 param_id, stddev_pop(y - f) sigma from {n}_fitted1 group by 1 union all select series, 2, stddev_pop(y - f) from {n}_fitted2 group by 1),
{n}_both as (select 1 param_id, * from {n}_pred1 union all select 2, * from {n}_pred2),
{n} as materialized (select series, param_id::bigint param_id, ds, yhat * scale yhat, (yhat - half) * scale yhat_lower, (yhat + half) * scale yhat_upper, trend * scale trend
 from (select b.*, scale, 1.96 * sqrt(sigma ** 2 + (case when len(beta) > 2 then list_avg(list_transform(beta[3:], lambda v: abs(v))) else 0 end
  * greatest((ds - last) / span::double, 0)) ** 2) half from {n}_both b join {n}_fit f using (series) join {n}_sigma s on s.series = b.series and s.param_id = b.param_id) q)""")
    return ",\n".join(parts)


def holidays_sql(holidays: str, dates: str) -> str:
    """``holiday_days``: every day on which a holiday acts, from the text of the holiday table over the years of ``dates``."""
    extra, _, final = holidays.rpartition("---")
    extra = extra.replace("select distinct year(o_orderdate)::int y from orders", f"select distinct year(ds)::int y from {dates}")
    return f"{extra.strip()},\nholiday_days as materialized (select distinct (ds + shift)::date ds, holiday as name from ({final.strip()}) h, (select unnest(range(7))::int shift) r)"


def mape_sql(name: str, both: str) -> str:
    """``name``(series, param_id, err) from ``both``(series, param_id, y, yhat)."""
    return f"""{name} as (select series, param_id, avg(abs(case when y <> 0 then (y - abs(yhat)) / y else abs(yhat) / m end)) * 100 err
 from (select *, avg(y) over (partition by series, param_id) m from {both}) e group by 1, 2)"""


def tune_sql(name: str, series: str) -> str:
    """``name``(series, param_id, train_mape, test_mape): fitted on the rows of ``series`` before the last 26 weeks."""
    return f"""{name}_split as materialized (select series, ds, y, ds < max(ds) over (partition by series) - 182 is_train from {series}),
{fit_sql(f'{name}_fits', f"(select * from {name}_split where is_train)", series)},
{name}_pairs as (select p.series, p.param_id, p.yhat, s.y, is_train from {name}_fits p join {name}_split s on s.series = p.series and s.ds = p.ds where s.y is not null),
{mape_sql(f'{name}_train', f"(select * from {name}_pairs where is_train)")},
{mape_sql(f'{name}_test', f"(select * from {name}_pairs where not is_train)")},
{name} as materialized (select t.series, t.param_id, t.err train_mape, e.err test_mape from {name}_train t full join {name}_test e on e.series = t.series and e.param_id = t.param_id)"""
