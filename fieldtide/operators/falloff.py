"""Fall-off of scheduled jobs: job table, roll-ups, scorecard and report levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtide.functions import dates, rules
from fieldtide.functions import fixed_values as fixed
from fieldtide.operators import calendar, joins

ROLES = {"isc_name": "PC", "ism_name": "IM"}


def keep_first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the lowest ``order`` per key. Aggregated map-side, so hot keys do not pile up."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def pivot_last_n(df: DataFrame, key: str, order: str, value: str, prefix: str, n: int = 3) -> DataFrame:
    """The values with the ``n`` highest orders as columns ``<prefix>_1..n``.

    The rank filter sits right on the window, so every task keeps ``n`` rows per key before
    anything is shuffled.
    """
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    ranked = df.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n)
    columns = [F.max(F.when(F.col("_n") == i, F.col(value))).alias(f"{prefix}_{i}") for i in range(1, n + 1)]
    return ranked.groupBy(key).agg(*columns)


def latest_n_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key in the given order, numbered in ``row_no``."""
    ranked = df.withColumn("row_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("row_no") <= n)


def lead_comments(comments: DataFrame, users: DataFrame, leads: DataFrame) -> DataFrame:
    """Last three comments of the given leads, with date and author."""
    text = F.concat(
        F.replace(F.col("cmcomment"), F.lit(r"\n"), F.lit("")), F.lit(" - "),
        F.substring(F.col("cmdatetime").cast("string"), 1, 10), F.lit(" - "),
        F.col("first_nm"), F.lit(" "), F.col("last_nm"),
    )
    lead = F.expr("try_cast(cmlead as bigint)").alias("_lead")
    wanted = comments.select(lead, "cmkey", "cmcomment", "cmdatetime", "cmuser")
    wanted = joins.semi_join(wanted, leads, {"_lead": "ldlead"})
    signed = wanted.join(users, F.col("cmuser") == F.col("user_no")).select("_lead", "cmkey", text.alias("_text"))
    return pivot_last_n(signed, "_lead", "cmkey", "_text", "lms_job_comment")


def lead_reasons(
    reasons: DataFrame, reason_names: DataFrame, subreason_names: DataFrame, users: DataFrame, leads: DataFrame
) -> DataFrame:
    """Last three reasons of the given leads; of equal (lead, reason, sub-reason) only the first counts."""
    lead = F.expr("try_cast(lrlead as bigint)").alias("_lead")
    wanted = reasons.select(lead, "lrkey", "lrreason", "lrsubreason", "lruser", "lrdate")
    wanted = joins.semi_join(wanted, leads, {"_lead": "ldlead"})
    first = keep_first_per_key(wanted, ["_lead", "lrreason", "lrsubreason"], "lrkey")
    named = joins.left_join_dims(first, [
        (reason_names, {"lrreason": "rmreason"}),
        (subreason_names, {"lrreason": "srreason", "lrsubreason": "srsubreason"}),
        (users, {"lruser": "user_no"}),
    ])
    text = F.concat(
        F.rtrim("rmdesc"), F.lit(": "), F.rtrim("srdesc"), F.lit(" - "),
        F.substring(F.col("lrdate").cast("string"), 1, 10), F.lit(" - "),
        F.col("first_nm"), F.lit(" "), F.col("last_nm"),
    )
    return pivot_last_n(named.select("_lead", "lrkey", text.alias("_text")), "_lead", "lrkey", "_text", "lms_job_reason")


def job_level_table(
    bow: DataFrame, leads: DataFrame, cal: DataFrame, assign: DataFrame, users: DataFrame, salesmen: DataFrame,
    comments: DataFrame, reasons: DataFrame, reason_names: DataFrame, subreason_names: DataFrame,
    as_of: str, *, previous_week_only: bool = True, compare: str = "week_no",
) -> DataFrame:
    """One row per scheduled job: status, measures, people, age, last comments and reasons.

    ``compare="week_no"`` compares week numbers without the year; ``"year_week"`` includes it.
    Every large input is shuffled once, by lead.
    """
    planned = bow.select(
        F.expr("try_cast(ldlead as bigint)").alias("_bow_lead"),
        F.col("ldjobenddate").cast("date").alias("orig_scheduled_job_end_date"),
    )
    if previous_week_only:
        week = calendar.previous_week(cal, as_of)
    else:
        week = cal
    planned = calendar.calendar_join(planned, week, "orig_scheduled_job_end_date", "plan", "inner")
    lead = leads.select(
        "ldlead", "ldlocation2", "ldsalesamt", "ldcandate", "ldsales1",
        *[F.col(c).cast("date").alias(c) for c in ("ldadate", "ldjobenddate", "ldfupdate")],
    )
    jobs = planned.join(lead, F.col("_bow_lead") == F.col("ldlead"), "left")
    jobs = jobs.withColumn("_new_date", F.coalesce("ldjobenddate", "ldfupdate"))
    jobs = calendar.calendar_join(jobs, cal, "_new_date", "new")
    jobs = joins.role_join(jobs, assign, users, ROLES, "ldlead")
    seller = salesmen.select(
        F.expr("try_cast(sm_no as bigint)").alias("_sm_no"),
        F.concat("sm_last_nm", F.lit(" "), "sm_first_nm").alias("sc_name"),
    )
    jobs = jobs.join(seller, F.col("ldsales1") == F.col("_sm_no"), "left")
    # Comments and reasons of other leads are left out before they are ranked and named.
    wanted = planned.select(F.col("_bow_lead").alias("ldlead"))
    for side in (lead_comments(comments, users, wanted), lead_reasons(reasons, reason_names, subreason_names, users, wanted)):
        jobs = jobs.join(side, F.col("ldlead") == F.col("_lead"), "left").drop("_lead")
    part = "wk_nbr" if compare == "week_no" else "wk_key"
    status = rules.job_status(F.col("ldcandate"), F.col(f"new_{part}"), F.col(f"plan_{part}"), F.col("ldfupdate"))
    age = dates.job_age_days(F.col("ldjobenddate"), F.col("ldfupdate"), F.col("ldadate"), as_of)
    rows = jobs.select(
        F.lit(as_of).cast("date").alias("data_refresh_date"),
        F.col("plan_wk_key").alias("fscl_yr_wk_key"),
        F.col("ldlead").alias("job"),
        F.lpad(F.col("ldlocation2").cast("string"), 4, "0").alias("str_nbr"),
        F.col("ldsalesamt").alias("job_amt"),
        status.alias("status"),
        "isc_name", "ism_name", "sc_name",
        F.col("ldjobenddate").alias("new_scheduled_job_end_date"),
        "orig_scheduled_job_end_date",
        F.col("ldfupdate").alias("fup_date"),
        age.alias("job_age_days"),
        *[f"lms_job_comment_{i}" for i in (1, 2, 3)],
        *[f"lms_job_reason_{i}" for i in (1, 2, 3)],
    )
    return rows.select("*", *rules.status_measures(F.col("status"), F.col("job_amt")))


def scn_jobs(jobs: DataFrame, loc: DataFrame) -> DataFrame:
    """Jobs at flagged locations."""
    flagged = loc.where(F.col("scn_flg") == "Y").select(F.col("loc_nbr").alias("str_nbr"))
    return jobs.join(flagged, "str_nbr").select(*jobs.columns)


def falloff_rollup(jobs: DataFrame, loc: DataFrame, keys: Sequence[str] = ("division", "region")) -> DataFrame:
    """Scheduled, per-status and fall-off sums of jobs at unflagged locations.

    Jobs are summed per store before the locations are joined: the wide rows are never
    shuffled, and a store with very many jobs is reduced by every task.
    """
    by = [c for c in ("data_refresh_date", "fscl_yr_wk_key") if c in jobs.columns]
    measures = [f"job_{kind}_{status.lower()}" for status in fixed.STATUSES for kind in ("amt", "count")]
    stores = jobs.groupBy(*by, "str_nbr").agg(
        F.sum("job_amt").alias("job_amt_scheduled"), F.count(F.lit(1)).alias("job_count_scheduled"),
        *[F.sum(m).alias(m) for m in measures],
    )
    places = loc.where(F.col("scn_flg") == "N").select(F.col("loc_nbr").alias("str_nbr"), *keys)
    sums = ["job_amt_scheduled", "job_count_scheduled", *measures]
    rolled = stores.join(places, "str_nbr").groupBy(*by, *keys).agg(*[F.sum(m).alias(m) for m in sums])
    amount_off = F.col("job_amt_scheduled") - F.col("job_amt_installed")
    count_off = F.col("job_count_scheduled") - F.col("job_count_installed")
    return rolled.select(
        "*",
        amount_off.alias("job_amt_fall_off"),
        count_off.alias("job_count_fall_off"),
        rules.safe_ratio(amount_off, F.col("job_amt_scheduled")).alias("falloff_pct_of_job_amt"),
        rules.safe_ratio(count_off, F.col("job_count_scheduled")).alias("falloff_pct_of_job_count"),
    )


def scorecard_metrics(
    scorecard: DataFrame, cal: DataFrame, loc: DataFrame, program_group: str, as_of: str | None = None
) -> DataFrame:
    """Job count and revenue by week and location levels; only the previous week when ``as_of`` is given."""
    rows = scorecard.where((F.col("program_group") == program_group) & (F.col("sfi_flg") == ""))
    week = calendar.previous_week(cal, as_of) if as_of else cal
    rows = calendar.calendar_join(rows, week, "cal_dt", "_sc", "inner")
    stores = rows.groupBy(F.col("_sc_wk_key").alias("fscl_yr_wk_key"), "str_nbr").agg(
        F.sum("ty_job_count").alias("job_count"), F.sum("ty_revenue").alias("ir")
    )
    placed = joins.left_join_dims(stores, [(loc, {"str_nbr": "loc_nbr"})])
    return placed.groupBy("fscl_yr_wk_key", "division", "region", "branch").agg(
        F.sum("job_count").alias("job_count"), F.sum("ir").alias("ir")
    )


def _with_scorecard(rollup: DataFrame, scorecard: DataFrame, keys: Sequence[str]) -> DataFrame:
    return joins.join_to_aggregate(
        rollup, scorecard, keys, {"scorecard_job_count": "job_count", "scorecard_ir": "ir"}
    )


def region_falloff(rollup: DataFrame, scorecard: DataFrame) -> DataFrame:
    return _with_scorecard(rollup, scorecard, ["division", "region"])


def branch_rank(df: DataFrame, n: int = 5) -> DataFrame:
    """Rank by fall-off ratio inside the division. The input holds one row per branch and week."""
    worst = Window.partitionBy("division").orderBy(F.col("falloff_pct_of_job_amt").desc())
    ranked = df.withColumn("rank_falloff_pct_of_job_amt", F.rank().over(worst).cast("long"))
    flag = rules.rank_flag(F.col("rank_falloff_pct_of_job_amt"), n)
    return ranked.withColumn(f"branch_top{n}_falloff_pct_of_job_amt", flag)


def branch_falloff(rollup: DataFrame, scorecard: DataFrame, n: int = 5) -> DataFrame:
    return branch_rank(_with_scorecard(rollup, scorecard, ["division", "branch"]), n)


REPORT_SUMS = {
    "scorecard_ir": "scorecard_ir",
    "scorecard_job_count": "scorecard_job_count",
    "job_amt_scheduled": "bow_scheduled",
    "job_count_scheduled": "bow_scheduled_jobs",
    "job_amt_canceled": "job_amt_canceled",
    "job_count_canceled": "job_count_canceled",
    "job_amt_rescheduled": "job_amt_rescheduled",
    "job_count_rescheduled": "job_count_rescheduled",
    "job_amt_unscheduled": "job_amt_unscheduled",
    "job_count_unscheduled": "job_count_unscheduled",
    "job_amt_aged": "job_amt_aged",
    "job_count_aged": "job_count_aged",
    "job_amt_installed": "job_amt_installed",
    "job_count_installed": "job_count_installed",
}
TOTAL = "Grand Total"


def report_levels(df: DataFrame, child: str = "region", *, grand_total: bool = True) -> DataFrame:
    """Division rows, child rows and the grand total from one pass (grouping sets).

    The level is taken from the grouping id, so a division or child without name is kept apart.
    """
    sets = [["division"], ["division", child]] + ([[]] if grand_total else [])
    columns = [[F.col(c) for c in group] for group in sets]
    sums = [F.sum(source).alias(new) for source, new in REPORT_SUMS.items()]
    level = F.grouping_id("division", child).alias("_level")
    rolled = df.groupingSets(columns, F.col("division"), F.col(child)).agg(level, *sums)
    amount_off = F.col("bow_scheduled") - F.col("job_amt_installed")
    count_off = F.col("bow_scheduled_jobs") - F.col("job_count_installed")
    is_total, is_division = F.col("_level") == 3, F.col("_level") == 1
    return rolled.select(
        F.when(is_total, TOTAL).otherwise(F.col("division")).alias("division"),
        F.when(is_total, TOTAL).when(is_division, "Division").otherwise(child.capitalize()).alias("location_level"),
        F.when(is_total, TOTAL).when(is_division, F.col("division")).otherwise(F.col(child)).alias("location"),
        *REPORT_SUMS.values(),
        amount_off.alias("job_amt_fall_off"),
        count_off.alias("job_count_fall_off"),
        rules.safe_ratio(amount_off, F.col("bow_scheduled")).alias("fall_off_pct_of_job_amt"),
        rules.safe_ratio(count_off, F.col("bow_scheduled_jobs")).alias("fall_off_pct_of_job_count"),
    )


def report_order(report: DataFrame) -> DataFrame:
    """Number the report lines: worst division first, its own row, then its children; the total last.

    A report has one row per location, so ordered windows over it are small. The ratio of the
    division comes from a window as well: a join of the report to itself would compute it twice.
    """
    is_division = F.col("location_level") == "Division"
    own = F.max(F.when(is_division, F.col("fall_off_pct_of_job_amt"))).over(Window.partitionBy("division"))
    named = F.when(F.col("division").isNotNull(), own)
    order = Window.orderBy(
        F.when(F.col("location_level") == TOTAL, 1).otherwise(0),
        F.col("_division_pct").desc_nulls_last(),
        F.col("division").asc_nulls_last(),
        F.when(is_division, 0).otherwise(1),
        F.col("fall_off_pct_of_job_amt").asc_nulls_first(),
        F.col("location").asc_nulls_last(),
    )
    lines = report.withColumn("_division_pct", named).withColumn("report_line", F.row_number().over(order).cast("long"))
    return lines.drop("_division_pct").orderBy("report_line")


def region_report(region: DataFrame) -> DataFrame:
    return report_order(report_levels(region, "region"))


def branch_report(branch: DataFrame, *, only_flagged: bool = False, n: int = 5) -> DataFrame:
    """All branches below their division; ``only_flagged`` keeps the worst ``n`` per division."""
    report = report_levels(branch, "branch", grand_total=False).drop("fall_off_pct_of_job_count")
    if only_flagged:
        flag = branch.where(F.col(f"branch_top{n}_falloff_pct_of_job_amt"))
        keep = flag.select("division", F.col("branch").alias("location")).distinct()
        listed = report.where(F.col("location_level") == "Branch").join(keep, ["division", "location"], "left_semi")
        report = report.where(F.col("location_level") == "Division").unionByName(listed)
    return report_order(report)


def worksheet_pivot(
    df: DataFrame, keys: Sequence[str] = ("division", "region"), measures: Sequence[str] = fixed.WORKSHEET_MEASURES
) -> DataFrame:
    """Sums of the measures, one row per key and measure, measures numbered in their fixed order."""
    sums = df.groupBy(*keys).agg(*[F.sum(m).cast("double").alias(m) for m in measures])
    long = sums.unpivot(list(keys), list(measures), "measure_name", "measure_value")
    number = F.create_map(*[F.lit(x) for i, m in enumerate(measures, 1) for x in (m, i)])
    return long.withColumn("measure_no", number[F.col("measure_name")].cast("long"))


def appointment_detail(
    leads: DataFrame, work_orders: DataFrame, appointments: DataFrame, record_types: DataFrame, record_type: str
) -> DataFrame:
    """Lead, work order and appointment rows of one record type.

    The filter on the record type rejects missing partners, so the joins are inner, and it is
    applied to the small record-type table first.
    """
    kind = record_types.where(F.col("name") == record_type).select(F.col("id").alias("record_type_id"))
    appts = appointments.join(kind, "record_type_id")
    orders = work_orders.select(
        "workorder_id", "workorder_created", F.expr("try_cast(lms_lead_id as bigint)").alias("ldlead")
    )
    return (
        leads.join(orders, "ldlead").join(appts, F.col("workorder_id") == F.col("parent_record_id"))
        .drop("parent_record_id", "record_type_id")
    )


def job_appointment_detail(jobs: DataFrame, appointments: DataFrame) -> DataFrame:
    """Job rows with their appointments; jobs without appointment stay."""
    return jobs.join(appointments, F.col("job") == F.col("ldlead"), "left")


