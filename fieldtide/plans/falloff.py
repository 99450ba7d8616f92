"""The weekly fall-off job: nine steps, each written and read back by the later ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldtide.operators import falloff
from fieldtide.plans.steps import Step, run_steps


def falloff_steps(inputs: Mapping[str, DataFrame], as_of: str, program_group: str, record_type: str, **options) -> list[Step]:
    """The steps over input tables named after the parameters of the operators.

    ``options`` go to the job table. Names of targets hold {STAGING}, {REPORTING} and {RUN_DATE}.
    """
    job_inputs = [inputs[n] for n in ("bow", "leads", "cal", "assign", "users", "salesmen", "comments", "reasons", "reason_names", "subreason_names")]
    loc = inputs["locations"]
    jobs, score, regions, branches, appts = (
        "{REPORTING}_job_level", "{STAGING}_scorecard_{RUN_DATE}", "{REPORTING}_region", "{REPORTING}_branch", "{REPORTING}_appointments")
    return [
        Step(0, lambda done: falloff.job_level_table(*job_inputs, as_of, **options), jobs),
        Step(0, lambda done: falloff.scorecard_metrics(inputs["scorecard"], inputs["cal"], loc, program_group), score),
        Step(1, lambda done: falloff.scn_jobs(done(jobs), loc), "{STAGING}_scn_jobs_{RUN_DATE}"),
        Step(1, lambda done: falloff.branch_falloff(falloff.falloff_rollup(done(jobs), loc, ["division", "branch"]), done(score)), branches),
        Step(1, lambda done: falloff.region_falloff(falloff.falloff_rollup(done(jobs), loc), done(score)), regions),
        Step(2, lambda done: falloff.region_report(done(regions)), "{STAGING}_region_report_{RUN_DATE}"),
        Step(2, lambda done: falloff.branch_report(done(branches), only_flagged=True), "{STAGING}_branch_report_{RUN_DATE}"),
        Step(3, lambda done: falloff.appointment_detail(
            inputs["lead_dates"], inputs["work_orders"], inputs["appointments"], inputs["record_types"], record_type), appts),
        Step(4, lambda done: falloff.job_appointment_detail(done(jobs), done(appts)), "{REPORTING}_job_appointments"),
    ]


def falloff_job(
    spark: SparkSession, inputs: Mapping[str, DataFrame], as_of: str, program_group: str, record_type: str, params: Mapping[str, str],
    out: str, **options,
) -> dict[str, DataFrame]:
    """Run the job; the written tables by their filled-in names."""
    return run_steps(spark, falloff_steps(inputs, as_of, program_group, record_type, **options), params, out)
