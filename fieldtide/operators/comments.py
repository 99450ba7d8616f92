"""Schedule-change events, the comments around them, and the reasons derived from both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.functions import dates, rules
from fieldtide.functions import fixed_values as fixed
from fieldtide.operators import calendar, joins, ordered


def audit_sequence(
    audits: DataFrame, key: str = "lead", order: Sequence[str] = ("audit_ts", "audit_key"), **options
) -> DataFrame:
    """Position of every audit of a lead from the start (``ord``) and from the end (``rev_ord``)."""
    return ordered.numbered(audits, [key], [F.col(c) for c in order], reverse="rev_ord", **options)


def prior_row_self_join(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], **options
) -> DataFrame:
    """Values of the preceding row of the key as ``prior_<column>``, with both positions."""
    previous = {f"prior_{c}": c for c in columns}
    return ordered.numbered(
        df, [key], [F.col(c) for c in order], reverse="rev_ord", previous=previous, **options
    )


def bool_any(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def max_text_reason(text: Column, history: Column | None = None) -> Column:
    return F.max(rules.reason_extract(text, history))


def ordered_string_agg(text: str, order: Sequence[str], separator: str = "|", empty: str | None = "") -> Column:
    """Texts of a group in the given order; NULL is skipped, a group without text gives ``empty``."""
    literal = separator.replace("'", "''")
    joined = F.expr(f"listagg({text}, '{literal}') within group (order by {', '.join(order)})")
    return joined if empty is None else F.coalesce(joined, F.lit(empty))


def reason_counts(comments: DataFrame, marker: str = fixed.SYSTEM_MARKER) -> DataFrame:
    """Frequency and first date of every reason named in system comments, most frequent first."""
    text = F.col("cmcomment")
    system = comments.where(
        text.contains(marker)
        & ~text.like(f"%Measure appointment %scheduled {marker}%")
        & ~text.like("Comments from % Workflow:  Email Status:  Submitted%")
    )
    groups = system.groupBy(
        rules.reason_label(text, marker).alias("comment"), rules.fn_like_flags(text).alias("weather_flag")
    )
    counted = groups.agg(F.count(F.lit(1)).alias("n"), F.min("cmdatetime").alias("start_date"))
    return counted.orderBy(F.desc("n"), "comment", "weather_flag")


def install_audits(audits: DataFrame, leads: DataFrame, as_of: str, days: int = 728, **options) -> DataFrame:
    """Install-date audits of leads opened in the last ``days``, numbered, with the prior audit."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = leads.where(F.col("ldadate") >= since).select(F.col("ldlead").alias("lead"), "ldfupdate")
    rows = audits.where(F.col("audit_type") == "INS").select("audit_key", "lead", "audit_ts", "plan_dt")
    rows = rows.join(recent, "lead")
    return prior_row_self_join(rows, "lead", ["audit_ts", "audit_key"], ["audit_ts", "plan_dt"], **options)


def history_chain(history: DataFrame, appointments: DataFrame, work_orders: DataFrame) -> DataFrame:
    """Appointment history with the lead of the work order that its appointment belongs to.

    History of an unknown appointment or work order keeps a row without lead, which matches no change.
    """
    parents = appointments.select("appt_id", "parent_record_id")
    leads = work_orders.select(F.col("workorder_id").alias("parent_record_id"), F.col("lms_lead_id").alias("lead"))
    rows = history.join(parents, "appt_id", "left").join(leads, "parent_record_id", "left")
    return rows.drop("appt_id", "parent_record_id")


def history_reasons(history: DataFrame, field: str = "Provider_Issues__c") -> DataFrame:
    """Reschedule requests of the appointment history: lead, UTC time and reason text."""
    asked = history.where(F.col("newvalue").like(f"{fixed.HISTORY_PREFIX}%") & (F.col("field") == field))
    return asked.select(
        F.expr("try_cast(lead as bigint)").alias("_h_lead"),
        F.col("reason_ts").alias("_h_ts"),
        F.substr(F.col("newvalue"), F.lit(24)).alias("_h_reason"),
    )


EVENT = ["lead", "ord", "rev_ord", "audit_ts", "plan_dt", "ldfupdate"]


def _changes(audits: DataFrame, history: DataFrame, cal: DataFrame, zone: str, hours: int) -> DataFrame:
    """Audits after the first with type, flag, and their history requests as reason and number."""
    later = audits.where(F.col("ord") > 1)
    later = later.withColumn("_utc", dates.fn_timezone(F.col("audit_ts"), zone))
    asked = joins.interval_join_symmetric(
        later.select("lead", "ord", "_utc"), history, {"lead": "_h_lead"}, "_utc", "_h_ts", hours, "hour", "inner"
    )
    # One row per audit before the comments are joined: comments x requests never multiply.
    asked = asked.groupBy("lead", "ord").agg(
        F.max("_h_reason").alias("_history_reason"), F.count(F.lit(1)).alias("_requests")
    )
    rows = later.join(asked, ["lead", "ord"], "left")
    for column, name in (("audit_ts", "_aud"), ("prior_audit_ts", "_paud"), ("prior_plan_dt", "_pje")):
        rows = rows.withColumn(f"{name}_dt", F.col(column).cast("date"))
        rows = calendar.calendar_join(rows, cal, f"{name}_dt", name)
    flag = rules.falloff_flag(F.col("_aud_wk_key"), F.col("_pje_wk_key"), F.col("_paud_wk_key"))
    return rows.select(
        *EVENT, "prior_audit_ts",
        rules.event_type_label(F.col("plan_dt")).alias("type"), flag.alias("falloff_flag"),
        "_history_reason", F.coalesce("_requests", F.lit(1)).cast("int").alias("_requests"),
    )


def _summed(matched: DataFrame, separator: str) -> DataFrame:
    """Reason, weather and joined texts (``_text``) of the comments matched to each event."""
    return matched.groupBy("lead", "ord").agg(
        max_text_reason(F.col("cmcomment")).alias("_reason"),
        F.bool_or(rules.fn_like_flags(F.col("cmcomment"))).alias("_weather"),
        ordered_string_agg("_text", ["cmdatetime", "cmkey"], separator, None).alias("_comments"),
    )


def _near(changes: DataFrame, comments: DataFrame, minutes: tuple[int, int], after_prior: bool, width: int) -> DataFrame:
    """Comments written within ``minutes`` of a change, and not before the change before it."""
    at = dates.unit_index(F.col("audit_ts"), "minute")
    low = at + minutes[0]
    if after_prior:
        low = F.greatest(low, dates.unit_index(F.col("prior_audit_ts"), "minute"))
    spans = changes.select("lead", "ord", "audit_ts", "prior_audit_ts", "_requests")
    when = dates.unit_index(F.col("cmdatetime"), "minute")
    return joins.between_join(spans, comments, {"lead": "cmlead"}, low, at + minutes[1], when, width)


def _labelled(changes: DataFrame, found: DataFrame) -> DataFrame:
    """Changes with reason (history first), weather and comments; NULL where no comment matched."""
    rows = changes.join(found, ["lead", "ord"], "left")
    reason = F.coalesce("_history_reason", "_reason", F.lit(fixed.NO_REASON))
    return rows.select(
        *EVENT, "type", "falloff_flag", reason.alias("selected_reason"),
        F.col("_weather").alias("weather_flag"), F.col("_comments").alias("comments"),
    )


def _aged_events(late: DataFrame, found: DataFrame) -> DataFrame:
    return late.join(found, ["lead", "ord"], "left").select(
        *EVENT, F.lit("Aged").alias("type"), F.lit(True).alias("falloff_flag"),
        F.lit(fixed.NO_REASON).alias("selected_reason"),
        F.col("_weather").alias("weather_flag"), F.col("_comments").alias("comments"),
    )


def _aged(audits, comments, cal, as_of):
    """Last audits whose completion week (today's when open) is after the planned week."""
    last = audits.where(F.col("rev_ord") == 1)
    last = last.withColumn("_done", F.coalesce("ldfupdate", F.lit(as_of).cast("date")))
    last = calendar.calendar_join(last, cal, "plan_dt", "_je")
    last = calendar.calendar_join(last, cal, "_done", "_fup")
    late = last.where(F.col("_fup_wk_key") > F.col("_je_wk_key")).select(*EVENT)
    low, high, at = (dates.unit_index(F.col(c), "day") for c in ("plan_dt", "ldfupdate", "cmdatetime"))
    spans = late.select("lead", "ord", "plan_dt", "ldfupdate")
    return late, joins.between_join(spans, comments, {"lead": "cmlead"}, low, high, at, 32)


def falloff_comments(
    audits: DataFrame, leads: DataFrame, comments: DataFrame, history: DataFrame, cal: DataFrame, as_of: str,
    *, minutes: tuple[int, int] = (-720, 60), hours: int = 5, zone: str = "America/New_York",
    distinct_comments: bool = False, **options,
) -> DataFrame:
    """Unscheduled, Rescheduled and Aged events with reason, weather flag and joined comments.

    A comment belongs to a change when it was written within ``minutes`` of it, but not before
    the change before. With several history requests near a change each comment is listed once
    per request, unless ``distinct_comments`` is set.
    """
    li = install_audits(audits, leads, as_of, **options)
    notes = comments.select("cmkey", "cmlead", "cmdatetime", "cmcomment")
    clean = rules.comment_clean(F.col("cmcomment"))
    changes = _changes(li, history_reasons(history), cal, zone, hours)
    # A lead with very many changes has short spans between them, so narrow slices keep its
    # comments apart; a span of 13 hours touches at most 14 of them.
    near = _near(changes, notes, minutes, True, 60)
    times = F.lit(1) if distinct_comments else F.col("_requests")
    near = near.withColumn("_text", F.array_join(F.array_repeat(clean, times), "|"))
    late, matched = _aged(li, notes, cal, as_of)
    matched = matched.withColumn("_text", clean)
    # Both halves hold one row per (lead, ord) and differ in type: a distinct would remove nothing.
    events = _labelled(changes, _summed(near, "|")).unionByName(_aged_events(late, _summed(matched, "|")))
    return events.fillna({"comments": "", "weather_flag": False})


def falloff_comments_dev(
    audits: DataFrame, leads: DataFrame, comments: DataFrame, history: DataFrame, cal: DataFrame, as_of: str,
    *, minutes: int = 5, hours: int = 5, zone: str = "America/New_York", **options,
) -> DataFrame:
    """The narrow variant: comments less than ``minutes`` away, raw texts, NULL where none matched."""
    li = install_audits(audits, leads, as_of, **options)
    notes = comments.select("cmkey", "cmlead", "cmdatetime", "cmcomment")
    changes = _changes(li, history_reasons(history), cal, zone, hours)
    near = _near(changes, notes, (1 - minutes, minutes - 1), False, 2 * minutes)
    raw = rules.scheduling_notes(F.col("cmcomment"), stamp=F.col("cmdatetime"))
    repeated = F.array_join(F.array_repeat(raw, F.col("_requests")), ",")
    near = near.withColumn("_text", F.when(raw.isNotNull(), repeated))
    late, matched = _aged(li, notes, cal, as_of)
    matched = matched.withColumn("_text", F.concat(F.col("cmdatetime").cast("string"), F.col("cmcomment")))
    return _labelled(changes, _summed(near, ",")).unionByName(_aged_events(late, _summed(matched, ",")))
