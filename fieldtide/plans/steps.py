"""A list of steps, each replacing its target table."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldtide.sources.sinks import write_overwrite

RESOLVE = "RESOLVE:"


@dataclass(frozen=True)
class Step:
    """SQL, or a function that gets a way to read earlier targets by name and returns a table."""

    order: int
    sql: str | Callable[[Callable[[str], DataFrame]], DataFrame]
    target: str


def resolve_params(spark: SparkSession, params: Mapping[str, str]) -> dict[str, str]:
    """Parameter values; one that starts with RESOLVE: is the single value of that query."""
    return {
        name: str(spark.sql(value.removeprefix(RESOLVE)).first()[0]) if value.startswith(RESOLVE) else value
        for name, value in params.items()
    }


def fill(text: str, params: Mapping[str, str]) -> str:
    """Replace {NAME} by its value; an unknown name is an error."""
    return re.sub(r"\{(\w+)\}", lambda m: params[m.group(1)], text)


def run_steps(spark: SparkSession, steps: Sequence[Step], params: Mapping[str, str], out: str) -> dict[str, DataFrame]:
    """Run the steps in order. Results are written below ``out`` and visible to later steps by name.

    A written table ends the lineage, so a lost executor repeats one step at most.
    """
    values, done = resolve_params(spark, params), {}
    for step in sorted(steps, key=lambda s: s.order):
        target = fill(step.target, values)
        rows = spark.sql(fill(step.sql, values)) if isinstance(step.sql, str) else step.sql(lambda name: done[fill(name, values)])
        done[target] = write_overwrite(rows, f"{out}/{target}")
        done[target].createOrReplaceTempView(target)
    return done
