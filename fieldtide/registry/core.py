"""Registration of queries with their check in SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.adapters import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(
    name: str, sql: str | None = None, *, views: Sequence[str] = (), digits: Mapping[str, int] | None = None,
    texts: Sequence[str] = (), recursive: bool = False,
):
    """Register ``fn(tables)``; ``sql`` (after the WITH of ``views``) must give the same rows.

    ``digits`` rounds the named columns on both sides (sums of doubles depend on the order of
    addition); ``texts`` casts dates and times to text on both sides; ``recursive`` allows
    the SQL to refer to itself.
    """
    digits = dict(digits or {})

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Tables(spark, folder))
            changed = {c: F.round(F.col(c).cast("double"), n) + F.lit(0.0) for c, n in digits.items()}
            changed |= {c: F.col(c).cast("string") for c in texts}
            return df.withColumns(changed) if changed else df

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            head = with_views(*views) + ",\n" if views else "with "
            head = head.replace("with ", "with recursive ", 1) if recursive else head
            changes = [f"round(cast({c} as double), {n}) + 0.0 as {c}" for c, n in digits.items()]
            changes += [f"cast({c} as varchar) as {c}" for c in texts]
            body = sql.strip()
            extra, _, final = body.rpartition("---")
            head += (extra.strip() + ",\n") if extra.strip() else ""
            replace = f" replace ({', '.join(changes)})" if changes else ""
            ORACLES[name] = f"{head}checked as ({final.strip()})\nselect *{replace} from checked"
        return fn

    return register
