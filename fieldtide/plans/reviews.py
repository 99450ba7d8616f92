"""The review job: from the newest run folder to the written set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.operators import reviews as rv
from fieldtide.sources import sinks, tables


def review_job(
    spark: SparkSession, folder: str, out: str, kind: str = "json", match: Callable[[Column, Column], Column] = rv.match_sentences,
) -> DataFrame:
    """Read the newest run below ``folder`` (folders ``run_date=<name>``), process its reviews, and write them to
    ``<out>/<name of the output of the run>``. Returns the set as read back; without any run nothing is written.
    """
    runs = tables.read_nested_reviews(spark, folder, kind, partition="run_date string")
    newest = runs.agg(F.max("run_date")).first()[0]
    if newest is None:
        return rv.review_sentences(runs.drop("run_date"), match)
    path = f"{out}/{tables.output_run_name(newest)}"
    sinks.review_output(rv.review_sentences(runs.where(F.col("run_date") == newest).drop("run_date"), match), path)
    return spark.read.parquet(path)
