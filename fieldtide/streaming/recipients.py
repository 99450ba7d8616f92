"""Who asked for results lately: as a batch and as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_recipients(
    df: DataFrame, as_of: str, minutes: int = 10, ts: str = "run_ts", cols: Sequence[str] = ("user", "mail", "run_ts")
) -> DataFrame:
    """Distinct recipients of the last ``minutes`` before ``as_of``."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(minutes))
    return df.where(F.col(ts) >= since).select(*cols).distinct()


def recent_recipients_stream(stream: DataFrame, cols: Sequence[str] = ("user", "mail", "run_ts"), keep: str = "30 days") -> DataFrame:
    """Each recipient once per run, however late a row comes.

    The watermark follows the time at which rows arrive, not that of their runs: no row is ever late, so none is lost, and
    a key leaves the state when ``keep`` has passed since it first arrived. The state is bounded by the runs of that time;
    a run that is replayed after it is handed on again.
    """
    arrived = stream.select(*cols).withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)
    return arrived.dropDuplicatesWithinWatermark(list(cols)).drop("_arrived")
