"""Job table, roll-ups, scorecard and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtide.adapters import AS_OF_ORDERS, Tables
from fieldtide.functions import dates, rules
from fieldtide.functions import fixed_values as fixed
from fieldtide.operators import calendar, falloff, joins
from fieldtide.plans.falloff import falloff_job
from fieldtide.registry.core import query
from fieldtide.session import scratch_path
from fieldtide.sources import sinks

LOW = [s.lower() for s in fixed.STATUSES]


def cal(t: Tables):
    return calendar.fiscal_calendar(t.spark, "1994-01-01", "2025-12-31")


def jobs(t: Tables, **options):
    options = {"previous_week_only": False, **options}
    return falloff.job_level_table(
        t.fx("fx_bow"), t.fx("fx_leads"), cal(t), t.fx("fx_assign"), t.fx("fx_users"), t.fx("fx_salesmen"),
        t.fx("fx_comments"), t.fx("fx_reasons"), t.fx("fx_reason_names"), t.fx("fx_subreason_names"),
        AS_OF_ORDERS, **options,
    )


def scorecard(t: Tables):
    return falloff.scorecard_metrics(t.fx("fx_scorecard"), cal(t), t.fx("fx_loc"), "MAIN")


def region_table(t: Tables):
    return falloff.region_falloff(falloff.falloff_rollup(jobs(t), t.fx("fx_loc")), scorecard(t))


def branch_table(t: Tables):
    rolled = falloff.falloff_rollup(jobs(t), t.fx("fx_loc"), ["division", "branch"])
    return falloff.branch_falloff(rolled, scorecard(t))


# A scheduled lead (plan), the week it was planned for (was), and the week of its new date (due).
STATUS_SQL = """case when lead.ldcandate is not null then 'Canceled' when due.cal_dt is null or due.fscl_wk_nbr is null then 'Unscheduled'
 when due.fscl_wk_nbr <> was.fscl_wk_nbr then 'Rescheduled' when lead.ldfupdate is null then 'Aged' else 'Installed' end"""
SCHEDULED = """fx_bow plan left join fx_leads lead on plan.ldlead = lead.ldlead join fx_cal was on was.cal_dt = plan.ldjobenddate {extra}
 left join fx_cal due on due.cal_dt = coalesce(lead.ldjobenddate, lead.ldfupdate)"""
MEASURES_SQL = ", ".join(
    f"case when status = '{s}' then job_amt else 0 end job_amt_{s.lower()}, "
    f"cast(case when status = '{s}' then 1 else 0 end as bigint) job_count_{s.lower()}" for s in fixed.STATUSES
)
JOB_VIEWS = ["fx_bow", "fx_leads", "fx_cal", "fx_assign", "fx_users", "fx_salesmen", "fx_comments", "fx_reasons",
             "fx_reason_names", "fx_subreason_names"]


def jobs_sql(extra: str = "", status: str = STATUS_SQL) -> str:
    slots = lambda table, kind: ", ".join(f"{table}.said[{i}] lms_job_{kind}_{i}" for i in (1, 2, 3))
    return f"""
people as (select user_no, first_nm || ' ' || last_nm who from fx_users),
staffed as (select ja_lead::bigint lead_no, ja_position duty, who from fx_assign left join people on user_no = ja_user),
sellers as (select sm_no::bigint seller, concat_ws(' ', sm_last_nm, sm_first_nm) who from fx_salesmen),
remarks as (select cmlead lead_no, list(array_to_string([replace(cmcomment, '\\n', ''), cmdatetime::date::varchar, who], ' - ') order by cmkey desc) said
 from fx_comments join people on user_no = cmuser semi join fx_bow on ldlead = cmlead group by 1),
causes as (select distinct on (lrlead, lrreason, lrsubreason) * from fx_reasons order by lrkey),
grounds as (select lrlead::bigint lead_no, list(rtrim(rmdesc) || ': ' || rtrim(srdesc) || ' - ' || lrdate::varchar || ' - ' || who order by lrkey desc) said
 from causes left join fx_reason_names on rmreason = lrreason left join fx_subreason_names on srreason = lrreason and srsubreason = lrsubreason
 left join people on user_no = lruser semi join fx_bow on ldlead = lrlead::bigint group by 1),
base as (select date '{AS_OF_ORDERS}' data_refresh_date, was.fscl_yr_wk_key, lead.ldlead job, format('{{:04d}}', lead.ldlocation2) str_nbr,
  lead.ldsalesamt job_amt, {status} status, coordinator.who isc_name, manager.who ism_name, sellers.who sc_name,
  lead.ldjobenddate new_scheduled_job_end_date, plan.ldjobenddate orig_scheduled_job_end_date, lead.ldfupdate fup_date,
  (coalesce(lead.ldjobenddate, lead.ldfupdate, date '{AS_OF_ORDERS}' - 1) - lead.ldadate)::bigint job_age_days,
  {slots('remarks', 'comment')}, {slots('grounds', 'reason')}
 from {SCHEDULED.format(extra=extra)}
 left join staffed manager on manager.lead_no = lead.ldlead and manager.duty = 'IM'
 left join staffed coordinator on coordinator.lead_no = lead.ldlead and coordinator.duty = 'PC'
 left join sellers on seller = lead.ldsales1
 left join remarks on remarks.lead_no = lead.ldlead left join grounds on grounds.lead_no = lead.ldlead),
jobs as (select *, {MEASURES_SQL} from base)
"""


JOB_DATES = ("data_refresh_date", "new_scheduled_job_end_date", "orig_scheduled_job_end_date", "fup_date")
JOB_AMOUNTS = {f"job_amt_{s}": 4 for s in LOW} | {"job_amt": 4}


@query("job_level_table", jobs_sql() + "---select * from jobs", views=JOB_VIEWS, texts=JOB_DATES, digits=JOB_AMOUNTS)
def job_level(t):
    return jobs(t)


@query("prev_week_join", """select b.ldlead, b.ldjobenddate, c.fscl_yr_wk_key from fx_bow b join fx_cal c on c.cal_dt = b.ldjobenddate
 where c.wk_begin = (select prev_wk_begin from fx_cal where cal_dt = date '1998-03-10')""",
       views=["fx_bow", "fx_cal"], texts=["ldjobenddate"])
def prev_week(t):
    return calendar.prev_week_join(t.fx("fx_bow"), cal(t), "ldjobenddate", AS_OF_ORDERS)


@query("job_level_previous_week",
       jobs_sql("and was.wk_begin = (select prev_wk_begin from fx_cal where cal_dt = date '1998-03-10')",
                STATUS_SQL.replace("fscl_wk_nbr", "fscl_yr_wk_key")) + "---select * from jobs",
       views=JOB_VIEWS, texts=JOB_DATES, digits=JOB_AMOUNTS)
def job_level_week(t):
    return jobs(t, previous_week_only=True, compare="year_week")


STATUS_FROM = "from " + SCHEDULED.format(extra="")


def _status_rows(t):
    lead = t.fx("fx_leads").withColumnRenamed("ldjobenddate", "new_end")
    rows = t.fx("fx_bow").join(lead, "ldlead", "left")
    rows = calendar.calendar_join(rows, cal(t), "ldjobenddate", "plan", "inner")
    rows = rows.withColumn("_d", F.coalesce("new_end", "ldfupdate"))
    rows = calendar.calendar_join(rows, cal(t), "_d", "new")
    status = rules.job_status(F.col("ldcandate"), F.col("new_wk_nbr"), F.col("plan_wk_nbr"), F.col("ldfupdate"))
    return rows.select("ldlead", "ldsalesamt", status.alias("status"))


@query("job_status", f"select plan.ldlead, {STATUS_SQL} status {STATUS_FROM}", views=["fx_bow", "fx_leads", "fx_cal"])
def status(t):
    return _status_rows(t).select("ldlead", "status")


@query("status_measures", f"""base as (select plan.ldlead, lead.ldsalesamt job_amt, {STATUS_SQL} status {STATUS_FROM})
---select ldlead, status, {MEASURES_SQL} from base""", views=["fx_bow", "fx_leads", "fx_cal"])
def measures(t):
    return _status_rows(t).select("ldlead", "status", *rules.status_measures(F.col("status"), F.col("ldsalesamt")))


@query("job_age_days", f"""select ldlead, date_diff('day', ldadate, coalesce(ldjobenddate, ldfupdate, date '{AS_OF_ORDERS}' - 1)) job_age_days
 from fx_leads""", views=["fx_leads"])
def age(t):
    days = dates.job_age_days(F.col("ldjobenddate"), F.col("ldfupdate"), F.col("ldadate"), AS_OF_ORDERS)
    return t.fx("fx_leads").select("ldlead", days.alias("job_age_days"))


@query("left_join_dims", """select l.ldlead, l.ldlocation2, u.first_nm, s.sm_last_nm, division, region from fx_leads l
 left join fx_users u on l.ldsales1 = u.user_no left join fx_salesmen s on cast(l.ldsales1 as varchar) = s.sm_no
 left join fx_loc on loc_nbr = lpad(cast(l.ldlocation2 as varchar), 4, '0')""",
       views=["fx_leads", "fx_users", "fx_salesmen", "fx_loc"])
def left_dims(t):
    rows = t.fx("fx_leads").select(
        "ldlead", "ldlocation2", "ldsales1", F.col("ldsales1").cast("string").alias("sm"),
        F.lpad(F.col("ldlocation2").cast("string"), 4, "0").alias("str_nbr"),
    )
    joined = joins.left_join_dims(rows, [
        (t.fx("fx_users").select("user_no", "first_nm"), {"ldsales1": "user_no"}),
        (t.fx("fx_salesmen").select("sm_no", "sm_last_nm"), {"sm": "sm_no"}),
        (t.fx("fx_loc").select("loc_nbr", "division", "region"), {"str_nbr": "loc_nbr"}),
    ])
    return joined.select("ldlead", "ldlocation2", "first_nm", "sm_last_nm", "division", "region")


@query("role_join", """select l.ldlead, isc.first_nm || ' ' || isc.last_nm isc_name, ism.first_nm || ' ' || ism.last_nm ism_name
 from fx_leads l left join fx_assign im on im.ja_position = 'IM' and cast(im.ja_lead as bigint) = l.ldlead
 left join fx_users ism on im.ja_user = ism.user_no
 left join fx_assign op on op.ja_position = 'PC' and cast(op.ja_lead as bigint) = l.ldlead
 left join fx_users isc on op.ja_user = isc.user_no""", views=["fx_leads", "fx_assign", "fx_users"])
def role(t):
    return joins.role_join(t.fx("fx_leads").select("ldlead"), t.fx("fx_assign"), t.fx("fx_users"), falloff.ROLES, "ldlead")


@query("keep_first_per_key", """select * from fx_reasons where lrkey in
 (select min(lrkey) from fx_reasons group by lrlead, lrreason, lrsubreason)""", views=["fx_reasons"], texts=["lrdate"])
def keep_first(t):
    return falloff.keep_first_per_key(t.fx("fx_reasons"), ["lrlead", "lrreason", "lrsubreason"], "lrkey")


@query("pivot_last_n", """select cmlead, max(case when n = 1 then cmcomment end) last_1, max(case when n = 2 then cmcomment end) last_2,
 max(case when n = 3 then cmcomment end) last_3
 from (select *, row_number() over (partition by cmlead order by cmkey desc) n from fx_comments) x group by cmlead""", views=["fx_comments"])
def pivot(t):
    return falloff.pivot_last_n(t.fx("fx_comments"), "cmlead", "cmkey", "cmcomment", "last")


@query("latest_n_rows", """select lrlead, lrkey, n row_no from (select *, row_number() over (partition by lrlead order by lrkey desc) n
 from fx_reasons) x where n <= 3""", views=["fx_reasons"])
def latest_n(t):
    return falloff.latest_n_rows(t.fx("fx_reasons"), ["lrlead"], [F.col("lrkey").desc()], 3).select("lrlead", "lrkey", F.col("row_no").cast("long").alias("row_no"))


SUMS_SQL = ", ".join(f"sum(job_{k}_{s}) job_{k}_{s}" if k == "amt" else f"cast(sum(job_count_{s}) as bigint) job_count_{s}"
                     for s in LOW for k in ("amt", "count"))
PCT = {"falloff_pct_of_job_amt": 8, "falloff_pct_of_job_count": 8}
AMOUNTS = {f"job_amt_{s}": 3 for s in [*LOW, "scheduled", "fall_off"]}


def rollup_sql(key: str) -> str:
    return f"""rolled as (select data_refresh_date, fscl_yr_wk_key, division, {key}, sum(job_amt) job_amt_scheduled, count(*) job_count_scheduled, {SUMS_SQL},
  sum(job_amt) - sum(job_amt_installed) job_amt_fall_off, cast(count(*) - sum(job_count_installed) as bigint) job_count_fall_off,
  (sum(job_amt) - sum(job_amt_installed)) / nullif(sum(job_amt), 0) falloff_pct_of_job_amt,
  (count(*) - sum(job_count_installed)) / nullif(count(*), 0) falloff_pct_of_job_count
 from jobs left join fx_loc on loc_nbr = str_nbr where scn_flg = 'N' group by 1, 2, 3, 4)"""


@query("falloff_rollup", jobs_sql() + ", " + rollup_sql("region") + "---select * from rolled",
       views=[*JOB_VIEWS, "fx_loc"], digits=AMOUNTS | PCT, texts=["data_refresh_date"])
def rollup(t):
    return falloff.falloff_rollup(jobs(t), t.fx("fx_loc"))


SCORE_SQL = """score as (select c.fscl_yr_wk_key, division, region, branch, cast(sum(ty_job_count) as bigint) job_count, sum(ty_revenue) ir
 from fx_scorecard x join fx_cal c on c.cal_dt = x.cal_dt left join fx_loc on loc_nbr = str_nbr
 where program_group = 'MAIN' and sfi_flg = '' group by 1, 2, 3, 4)"""


@query("scorecard_metrics", SCORE_SQL + "---select * from score", views=["fx_scorecard", "fx_cal", "fx_loc"], digits={"ir": 3})
def score(t):
    return scorecard(t)


def joined_sql(key: str, out: str) -> str:
    return jobs_sql() + ", " + rollup_sql(key) + ", " + SCORE_SQL + f""",
 {out} as (select a.*, b.scorecard_job_count, b.scorecard_ir from rolled a left join
  (select division, {key}, cast(sum(job_count) as bigint) scorecard_job_count, sum(ir) scorecard_ir from score group by 1, 2) b
  on a.division = b.division and a.{key} = b.{key})"""


REPORT_VIEWS = [*JOB_VIEWS, "fx_loc", "fx_scorecard"]
IR = {"scorecard_ir": 2}


@query("region_falloff", joined_sql("region", "regions") + "---select * from regions", views=REPORT_VIEWS,
       digits=AMOUNTS | PCT | IR, texts=["data_refresh_date"])
def region(t):
    return region_table(t)


@query("join_to_aggregate", SCORE_SQL + """---select s.fscl_yr_wk_key, s.division, s.region, s.branch, s.job_count, d.division_jobs
 from score s left join (select division, cast(sum(job_count) as bigint) division_jobs from score group by 1) d on d.division = s.division""",
       views=["fx_scorecard", "fx_cal", "fx_loc"])
def to_aggregate(t):
    rows = scorecard(t).drop("ir")
    joined = joins.join_to_aggregate(rows, rows, ["division"], {"division_jobs": "job_count"})
    return joined.select("fscl_yr_wk_key", "division", "region", "branch", "job_count", "division_jobs")


BRANCH_SQL = joined_sql("branch", "b0") + """, branches as (select *, rank_falloff_pct_of_job_amt <= 5 branch_top5_falloff_pct_of_job_amt from
 (select *, rank() over (partition by division order by falloff_pct_of_job_amt desc nulls last) rank_falloff_pct_of_job_amt
  from (select * replace (round(falloff_pct_of_job_amt, 8) as falloff_pct_of_job_amt) from b0) b1) r)"""


@query("branch_falloff", BRANCH_SQL + "---select * from branches", views=REPORT_VIEWS, digits=AMOUNTS | PCT | IR, texts=["data_refresh_date"])
def branch(t):
    # The ratio is rounded before ranking: equal ratios must tie in every order of addition.
    rolled = falloff.falloff_rollup(jobs(t), t.fx("fx_loc"), ["division", "branch"])
    rolled = rolled.withColumn("falloff_pct_of_job_amt", F.round("falloff_pct_of_job_amt", 8))
    return falloff.branch_falloff(rolled, scorecard(t))


RANK_SQL = """r as (select division, region, branch, sum(ir) ir from score group by 1, 2, 3)
---select division, branch, rank() over (partition by division order by round(ir, 2) desc nulls last) falloff_rank,
 rank() over (partition by division order by round(ir, 2) desc nulls last) <= 5 top5 from r"""


@query("branch_rank", SCORE_SQL + ", " + RANK_SQL, views=["fx_scorecard", "fx_cal", "fx_loc"])
def ranks(t):
    sums = scorecard(t).groupBy("division", "region", "branch").agg(F.round(F.sum("ir"), 2).alias("falloff_pct_of_job_amt"))
    ranked = falloff.branch_rank(sums)
    return ranked.select("division", "branch", F.col("rank_falloff_pct_of_job_amt").alias("falloff_rank"),
                         F.col("branch_top5_falloff_pct_of_job_amt").alias("top5"))


REPORT_NAMES = ["scorecard_ir", "scorecard_job_count", "bow_scheduled", "bow_scheduled_jobs", "job_amt_canceled",
                "job_count_canceled", "job_amt_rescheduled", "job_count_rescheduled", "job_amt_unscheduled",
                "job_count_unscheduled", "job_amt_aged", "job_count_aged", "job_amt_installed", "job_count_installed"]
REPORT_SUMS_SQL = ", ".join(
    f"{'cast(' if 'count' in src else ''}sum({src}){' as bigint)' if 'count' in src else ''} {new}"
    for src, new in falloff.REPORT_SUMS.items()
)
REPORT_DIGITS = {n: 2 for n in REPORT_NAMES if "amt" in n or n in ("bow_scheduled", "scorecard_ir")} | {
    "job_amt_fall_off": 2, "fall_off_pct_of_job_amt": 8}


def levels_sql(source: str, key: str, label: str, total: bool) -> str:
    tail = f""", sum(job_amt_scheduled) - sum(job_amt_installed) job_amt_fall_off,
 cast(sum(job_count_scheduled) - sum(job_count_installed) as bigint) job_count_fall_off,
 (sum(job_amt_scheduled) - sum(job_amt_installed)) / nullif(sum(job_amt_scheduled), 0) fall_off_pct_of_job_amt,
 (sum(job_count_scheduled) - sum(job_count_installed)) / nullif(sum(job_count_scheduled), 0) fall_off_pct_of_job_count from {source}"""
    parts = [
        f"select division, 'Division' location_level, division as location, {REPORT_SUMS_SQL} {tail} group by division",
        f"select division, '{label}' location_level, {key} as location, {REPORT_SUMS_SQL} {tail} group by division, {key}",
    ]
    if total:
        parts.append(f"select 'Grand Total', 'Grand Total', 'Grand Total', {REPORT_SUMS_SQL} {tail}")
    return "levels as (" + " union all ".join(parts) + ")"


LINES_SQL = """select a.*, row_number() over (order by case when a.location_level = 'Grand Total' then 1 else 0 end, b.p desc nulls last,
  a.division nulls last, case when a.location_level = 'Division' then 0 else 1 end, a.fall_off_pct_of_job_amt nulls first,
  a.location nulls last) report_line
 from levels a left join (select division, fall_off_pct_of_job_amt p from levels where location_level = 'Division') b on a.division = b.division"""


@query("report_levels", joined_sql("region", "regions") + ", " + levels_sql("regions", "region", "Region", True) + "---select * from levels",
       views=REPORT_VIEWS, digits=REPORT_DIGITS | {"fall_off_pct_of_job_count": 8})
def levels(t):
    return falloff.report_levels(region_table(t))


@query("region_report", joined_sql("region", "regions") + ", " + levels_sql("regions", "region", "Region", True) + "---" + LINES_SQL,
       views=REPORT_VIEWS, digits=REPORT_DIGITS | {"fall_off_pct_of_job_count": 8})
def region_rep(t):
    return falloff.region_report(region_table(t))


@query("branch_report", BRANCH_SQL + ", " + levels_sql("branches", "branch", "Branch", False)
       + "---select * exclude (fall_off_pct_of_job_count) from (" + LINES_SQL + ") z", views=REPORT_VIEWS, digits=REPORT_DIGITS)
def branch_rep(t):
    return falloff.branch_report(branch_table(t))


def job_tables(t):
    """All steps of the weekly job, written below the scratch folder."""
    names = {
        "bow": "fx_bow", "leads": "fx_leads", "assign": "fx_assign", "users": "fx_users", "salesmen": "fx_salesmen", "comments": "fx_comments",
        "reasons": "fx_reasons", "reason_names": "fx_reason_names", "subreason_names": "fx_subreason_names", "locations": "fx_loc",
        "scorecard": "fx_scorecard", "work_orders": "fx_workorders", "appointments": "fx_appointments", "record_types": "fx_record_types",
    }
    inputs = {name: t.fx(view) for name, view in names.items()} | {"cal": cal(t), "lead_dates": t.fx("fx_lead_dates").select("ldlead", "ldfupdate")}
    params = {"STAGING": "stage", "REPORTING": "report", "RUN_DATE": "RESOLVE:select replace(cast(date '2024-02-05' as string), '-', '')"}
    return falloff_job(t.spark, inputs, AS_OF_ORDERS, "MAIN", "ASIA", params, scratch_path(t.spark, "falloff"), previous_week_only=False)


@query("falloff_job", joined_sql("region", "regions") + ", " + levels_sql("regions", "region", "Region", True) + "---" + LINES_SQL,
       views=REPORT_VIEWS, digits=REPORT_DIGITS | {"fall_off_pct_of_job_count": 8})
def job(t):
    """The region report that the nine steps leave."""
    return job_tables(t)["stage_region_report_20240205"]


@query("falloff_report_lines", joined_sql("region", "regions") + ", " + levels_sql("regions", "region", "Region", True) + f""", body as ({LINES_SQL})
---select * from (select 1 line_no, null c1, 'Fall Off Report' c2, null c3, null c4, null c5 union all select 2, null, 'by Division and Region', null, null, null
 union all select 3, null, '', null, null, null
 union all select 3 + report_line, cast(report_line as varchar), division, location_level, location, cast(bow_scheduled_jobs as varchar) from body) x""", views=REPORT_VIEWS)
def report_body(t):
    """The title block and the rows of the region report."""
    body = region_rep(t).select("report_line", "division", "location_level", "location", "bow_scheduled_jobs")
    return sinks.report_lines(body, ["Fall Off Report", "by Division and Region", ""], [F.col("report_line")])


@query("report_order", SCORE_SQL + """, levels as (
  select division, 'Division' location_level, division as location, sum(job_count) / 1000.0 fall_off_pct_of_job_amt from score group by 1
  union all select division, 'Region', region, sum(job_count) / 1000.0 from score group by 1, 3)
---select division, location_level, location, report_line from (""" + LINES_SQL + ") z", views=["fx_scorecard", "fx_cal", "fx_loc"])
def order(t):
    rows = scorecard(t)
    pct = (F.sum("job_count") / 1000.0).alias("fall_off_pct_of_job_amt")
    top = rows.groupBy("division").agg(pct).select("division", F.lit("Division").alias("location_level"), F.col("division").alias("location"), "fall_off_pct_of_job_amt")
    low = rows.groupBy("division", "region").agg(pct).select("division", F.lit("Region").alias("location_level"), F.col("region").alias("location"), "fall_off_pct_of_job_amt")
    return falloff.report_order(top.unionByName(low)).drop("fall_off_pct_of_job_amt")


WORKSHEET_SQL = " union all ".join(
    f"select division, region, '{m}' measure_name, cast(sum({m}) as double) measure_value, {i} measure_no from regions group by 1, 2"
    for i, m in enumerate(fixed.WORKSHEET_MEASURES, 1))


@query("worksheet_pivot", joined_sql("region", "regions") + "---select * from (" + WORKSHEET_SQL + ") w", views=REPORT_VIEWS, digits={"measure_value": 2})
def worksheet(t):
    return falloff.worksheet_pivot(region_table(t))


@query("scn_jobs", jobs_sql() + "---select job, str_nbr, status, job_amt from jobs join fx_loc on loc_nbr = str_nbr and scn_flg = 'Y'", views=[*JOB_VIEWS, "fx_loc"])
def scn(t):
    return falloff.scn_jobs(jobs(t), t.fx("fx_loc")).select("job", "str_nbr", "status", "job_amt")


APPT_SQL = """appts as (select l.ldlead, l.ldfupdate, w.workorder_id, w.workorder_created, a.appt_id, a.appt_created, a.appt_status, a.appt_value
 from fx_lead_dates l left join fx_workorders w on cast(l.ldlead as varchar) = w.lms_lead_id
 left join fx_appointments a on w.workorder_id = a.parent_record_id
 left join fx_record_types r on a.record_type_id = r.id where r.name = 'ASIA')"""
APPT_VIEWS = ["fx_lead_dates", "fx_workorders", "fx_appointments", "fx_record_types"]
APPT_TIMES = ("ldfupdate", "workorder_created", "appt_created")


def appts(t):
    return falloff.appointment_detail(
        t.fx("fx_lead_dates").select("ldlead", "ldfupdate"), t.fx("fx_workorders"), t.fx("fx_appointments"), t.fx("fx_record_types"), "ASIA")


@query("appointment_detail", APPT_SQL + "---select * from appts", views=APPT_VIEWS, texts=APPT_TIMES)
def appointment(t):
    return appts(t).orderBy("workorder_created", "appt_created")


@query("job_appointment_detail", jobs_sql() + ", " + APPT_SQL + """---select job, status, job_amt, workorder_id, appt_id, appt_created
 from jobs left join appts on ldlead = job""", views=[*JOB_VIEWS, *APPT_VIEWS], texts=["appt_created"])
def job_appointment(t):
    rows = falloff.job_appointment_detail(jobs(t), appts(t))
    return rows.select("job", "status", "job_amt", "workorder_id", "appt_id", "appt_created")
