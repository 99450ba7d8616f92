"""Status, reason and bucket rules as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldtide.functions import fixed_values as fixed


def job_status(
    canceled: Column, new_week: Column, planned_week: Column, follow_up: Column
) -> Column:
    """Canceled, Rescheduled, Aged, Unscheduled, Installed or Error; the first match wins.

    Pass week numbers to compare weeks only, or year-week keys to compare years as well.
    """
    return (
        F.when(canceled.isNotNull(), "Canceled")
        .when(new_week != planned_week, "Rescheduled")
        .when((new_week == planned_week) & follow_up.isNull(), "Aged")
        .when(new_week.isNull(), "Unscheduled")
        .when(planned_week == new_week, "Installed")
        .otherwise("Error")
    )


def status_measures(status: Column, amount: Column, statuses: Sequence[str] = fixed.STATUSES) -> list[Column]:
    """Amount and 0/1 count of every status, as ``job_amt_<status>`` and ``job_count_<status>``."""
    columns = []
    for name in statuses:
        hit, low = status == name, name.lower()
        columns.append(F.when(hit, amount).otherwise(F.lit(0.0)).alias(f"job_amt_{low}"))
        columns.append(F.when(hit, 1).otherwise(0).cast("long").alias(f"job_count_{low}"))
    return columns


def event_type_label(new_date: Column) -> Column:
    return F.when(new_date.isNull(), "Unscheduled").otherwise("Rescheduled")


def falloff_flag(week: Column, prior_planned_week: Column, prior_week: Column) -> Column:
    """True when this change came no earlier than the week planned before and the change before."""
    return F.coalesce((week >= prior_planned_week) & (week >= prior_week), F.lit(False))


def store_rank(weeks: Column) -> Column:
    """1 for an empty store, 2 below two weeks of supply, 3 otherwise (unknown included)."""
    return F.when(weeks == 0, 1).when(weeks < 2, 2).otherwise(3)


def rank_flag(rank: Column, n: int = 5) -> Column:
    return F.coalesce(rank <= n, F.lit(False))


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def fn_like_flags(text: Column, patterns: Sequence[str] = fixed.WEATHER_PATTERNS) -> Column:
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.like(p) for p in patterns])


def _coded_reason(text: Column, code: str, lead: int) -> Column:
    """The part from ``lead`` characters before ``code`` to the scheduling comments (or the end)."""
    start = F.instr(text, code)
    notes = F.instr(text, fixed.SCHEDULING_COMMENTS)
    end = F.when(notes > 0, notes).otherwise(F.length(text))
    return F.substr(text, start - lead, end + lead - start)


def reason_extract(text: Column, history: Column | None = None, marker: str = fixed.SYSTEM_MARKER) -> Column:
    """Reason of a schedule change; a reason from the appointment history goes first."""
    def has(pattern: str) -> Column:
        return text.like(pattern)

    found = (
        F.when(has("Service appointment scheduled by % failed%"), "Service appointment scheduling failed")
        .when(has("%Installer appointment scheduled by %"), "Installer appointment scheduled")
        .when(has("%Service appointment scheduled by %"), "Service appointment scheduled")
        .when(has("%Unschedule Reason code -  Other%"), "Unschedule Reason code -  Other")
        .when(has("%Reschedule Reason code -  Other%"), "Reschedule Reason code -  Other")
        .when(has(f"%{fixed.RESCHEDULE_CODE}%"), _coded_reason(text, fixed.RESCHEDULE_CODE, 2))
        .when(has(f"%{fixed.OVERRIDE_CODE}%"), _coded_reason(text, fixed.OVERRIDE_CODE, 0))
        .when(has("%appointment %scheduled by %"), fixed.NO_REASON)
        .otherwise(text)
    )
    reason = F.when(text.like(f"%{marker}%"), found).otherwise(fixed.NO_REASON)
    return reason if history is None else F.coalesce(history, reason)


def reason_label(text: Column, marker: str = fixed.SYSTEM_MARKER) -> Column:
    """Reason names for the frequency list; the labels keep the marker."""
    def has(pattern: str) -> Column:
        return text.like(pattern)

    labels = {
        f"Service appointment scheduled {marker} failed%": f"Service appointment scheduled {marker} failed",
        f"%Installer appointment scheduled {marker}%": f"Installer appointment scheduled {marker}",
        f"%Service appointment scheduled {marker}%": f"Service appointment scheduled {marker}",
        "%Unschedule Reason code -  Other%": "Unschedule Reason code -  Other",
        "%Reschedule Reason code -  Other%": "Reschedule Reason code -  Other",
    }
    chain = F
    for pattern, label in labels.items():
        chain = chain.when(has(pattern), label)
    return (
        chain.when(has(f"%{fixed.RESCHEDULE_CODE}%"), _coded_reason(text, fixed.RESCHEDULE_CODE, 2))
        .when(has(f"%{fixed.OVERRIDE_CODE}%"), _coded_reason(text, fixed.OVERRIDE_CODE, 0))
        .when(has(f"%appointment Re-scheduled {marker}%"), "No Re-schedule reason given")
        .otherwise(text)
    )


def comment_clean(
    text: Column,
    empty: Sequence[str] = fixed.EMPTY_COMMENT_PATTERNS,
    markers: Sequence[str] = fixed.SYSTEM_MARKERS,
    noise: str = fixed.COMMENT_NOISE,
) -> Column:
    """Comment without system text: '' for notices, only the notes of system comments."""
    notice = reduce(lambda a, b: a | b, [text.like(p) for p in empty])
    kept = F.coalesce(F.when(notice, "").otherwise(scheduling_notes(text, markers)), F.lit(""))
    return F.regexp_replace(F.regexp_replace(kept, noise, ""), r"^\s+|\s+$", "")


def scheduling_notes(text: Column, markers: Sequence[str] = fixed.SYSTEM_MARKERS, stamp: Column | None = None) -> Column:
    """System comments are cut down to their scheduling notes; others stay whole."""
    system = reduce(lambda a, b: a | b, [text.contains(m) for m in markers])
    at = F.instr(text, fixed.SCHEDULING_COMMENTS)
    notes = F.substr(text, at)
    if stamp is not None:
        notes = F.concat(stamp.cast("string"), F.lit(" "), notes)
    return F.when(system, F.when(at > 0, notes).otherwise("")).otherwise(text)


def lookup_replace(value: Column, mapping: Mapping[str, object]) -> Column:
    """Mapped value, or the value itself when it is not listed."""
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.when(value.isin(list(mapping)), F.create_map(*flat)[value]).otherwise(value)
