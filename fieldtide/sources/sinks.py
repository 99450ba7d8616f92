"""Writing results: tables, dated and chunked extracts, report lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtide.operators import ordered


def write_overwrite(df: DataFrame, target: str) -> DataFrame:
    """Replace the Parquet table at ``target`` and return it as read back."""
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.parquet(target)


def review_output(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv_dated(tables: Mapping[str, DataFrame], out: str, date: str) -> list[str]:
    """One CSV folder per table below ``<out>/<date>/``; each is written by all tasks."""
    paths = []
    for name, df in tables.items():
        path = f"{out}/{date}/{name}.csv"
        df.write.mode("overwrite").option("header", True).csv(path)
        paths.append(path)
    return paths


def export_csv_chunked(df: DataFrame, order: Sequence[Column], out: str, date: str, size: int = 1999) -> str:
    """CSV files of ``size`` rows each (the last may be shorter) in the given order, all in one dated folder.

    Every task takes whole chunks, in order, and Spark's writer begins a new file after each ``size`` rows, so there is one
    file per chunk and its name tells its place: task, then number in the task (``chunk_files``). Files appear when the
    task that wrote them is committed; no folder is made per chunk.
    """
    path = f"{out}/override_upload_{date}"
    rows = ordered.chunk_numbers(df, order, size)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(tasks, "chunk_no").sortWithinPartitions("row_no").drop("row_no", "chunk_no")
    rows.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", size).csv(path)
    return path


def chunk_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the files of ``export_csv_chunked`` with ``chunk_no``, counted from 1 in the order of the file names."""
    rows = spark.read.csv(path, schema=schema, header=True).select("*", F.col("_metadata.file_name").alias("_file"))
    names = rows.select("_file").distinct()
    task, place = (F.regexp_extract("_file", p, 1).cast("int") for p in (r"^part-([0-9]+)-", r"-c([0-9]+)\."))
    numbers = names.select("_file", F.row_number().over(Window.orderBy(task, place)).cast("long").alias("chunk_no"))
    return rows.join(numbers, "_file").drop("_file")


def recipient_rows(results: DataFrame, recipients: DataFrame, keys: Sequence[str] = ("user", "run_ts")) -> DataFrame:
    """Result rows of the given recipients and run times."""
    return results.join(recipients.select(*keys).distinct(), list(keys), "left_semi")


LARGE = 1_000_000  # rows of an extract that one task writes


def export_by_recipient(results: DataFrame, recipients: DataFrame, out: str, keys: Sequence[str] = ("user", "run_ts")) -> None:
    """One folder of CSV files per recipient and run time.

    The extracts are dealt to a fixed number of tasks, as many small ones cost time by the folder and not by their size; an
    extract of more than ``LARGE`` rows goes to several tasks. Each task moves its own files to their folders when it is
    done, as the driver would move those of all extracts one by one: a failed run can leave some of them.
    """
    rows = recipient_rows(results, recipients, keys)
    parts = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / LARGE).alias("_parts")).where("_parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64(*results.columns), F.col("_parts")), F.lit(0))
    tasks = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(parts, list(keys), "left").repartition(tasks, *keys, part).select(*results.columns)
    dealt.write.mode("overwrite").option("header", True).option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*keys).csv(out)


def report_lines(body: DataFrame, header: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Title lines in the second column, then the body, as numbered lines of text cells."""
    spark, n = body.sparkSession, len(header)
    cells = [f"c{i}" for i in range(1, len(body.columns) + 1)]
    rows = ordered.numbered(body, [], order, number="_n")
    lines = rows.select(
        (F.col("_n") + n).alias("line_no"), *[F.col(c).cast("string").alias(x) for c, x in zip(body.columns, cells)]
    )
    titles = spark.createDataFrame(list(enumerate(header, 1)), "line_no long, c2 string")
    return titles.unionByName(lines, allowMissingColumns=True).select("line_no", *cells).orderBy("line_no")
