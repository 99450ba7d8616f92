"""Reading tables, files and folders."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fieldtide.functions import fixed_values as fixed
from fieldtide.operators import columns


def scan_table(spark: SparkSession, name_or_sql: str, args: Mapping | None = None) -> DataFrame:
    """A query (with named parameters), a table of the catalog, or a Parquet path."""
    text = name_or_sql.strip()
    if text.lower().startswith(("select ", "with ", "select\n", "with\n")):
        return spark.sql(text, args=dict(args or {}))
    if "/" in text:
        return spark.read.parquet(text)
    return spark.table(text)


def read_headerless_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV whose first line is data. A value that does not fit the schema fails the read."""
    return spark.read.csv(path, schema=schema, header=False, mode="FAILFAST")


def read_headered_csv(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """CSV with a header line, which must name the columns of ``schema`` (all text without one)."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


FILE = "_metadata.file_path as _file"
ROOT = r"^([A-Za-z0-9+.-]+):/+"  # a local file is file:/ in one place and file:/// in another
FEW_FILES = 10_000  # up to this many files their list is sent to every task


def text_columns(width: int) -> StructType:
    """``width`` text columns without names of their own."""
    return StructType([StructField(f"_c{i}", StringType()) for i in range(width)])


def file_rows(reader, path: str, width: int) -> DataFrame:
    """The rows of CSV files below their first line, as text, with the file they come from. For batch and stream readers."""
    rows = reader.schema(text_columns(width)).option("header", True).option("enforceSchema", True).option("mode", "FAILFAST").csv(path)
    return rows.selectExpr("*", FILE)


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that is not empty, through Spark's own file systems; None for an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = lines.readLine()
        while line is not None and not line.strip():
            line = lines.readLine()
        return line
    finally:
        stream.close()


def header_orders(spark: SparkSession, files: Iterable[str], names: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by the order of the columns in their header. Only the first line of each file is read.

    A header names exactly the declared columns, in any order and with blanks for underscores; a file without one is an
    error. Files without any line have no rows and are left out.
    """
    files = list(files)
    with ThreadPoolExecutor(32) as pool:
        heads = list(pool.map(lambda f: first_line(spark, f), files))
    orders: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, heads):
        if line is None:
            continue
        order = tuple(cell.replace(" ", "_") for cell in next(csv.reader([line])))
        if sorted(order) != sorted(names):
            raise ValueError(f"no header of the declared columns in {file}: {line[:200]!r}")
        orders.setdefault(order, []).append(file)
    return orders


def aligned_by_name(rows: DataFrame, orders: Mapping[tuple[str, ...], Sequence[str]], schema: str = fixed.PARAMETER_FILE_SCHEMA) -> DataFrame:
    """Rows of ``file_rows`` in the declared columns and types, each value by its name in the header of its file.

    The places of the columns are constants of the plan, one set per order that occurs; with a single order no row is
    joined to anything.
    """
    names = [f.name for f in StructType.fromDDL(schema).fields]
    listed = list(orders)
    if len(listed) > 1:
        files = rows.sparkSession.createDataFrame([(re.sub(ROOT, r"\1:/", f), i) for i, order in enumerate(listed) for f in orders[order]], "_of string, _order int")
        files = F.broadcast(files) if sum(map(len, orders.values())) <= FEW_FILES else files
        rows = rows.join(files, F.regexp_replace("_file", ROOT, "$1:/") == F.col("_of"))

    def value(name: str) -> Column:
        places = [order.index(name) for order in listed]
        if len(set(places)) <= 1:
            return F.col(f"_c{places[0] if places else names.index(name)}")
        chosen = F.when(F.col("_order") == 0, F.col(f"_c{places[0]}"))
        for i, place in enumerate(places[1:], 1):
            chosen = chosen.when(F.col("_order") == i, F.col(f"_c{place}"))
        return chosen

    return cast_declared(rows.select(*[value(n).alias(n) for n in names]), schema)


def loaded(rows: DataFrame, loaded_at: str, hours: int) -> DataFrame:
    """Without rows that hold no value, with the load time ``hours`` after ``loaded_at``."""
    rows = columns.drop_all_null(rows, rows.columns)
    return rows.withColumn("time", F.lit(loaded_at).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours)))


def cast_declared(df: DataFrame, schema: str = fixed.PARAMETER_FILE_SCHEMA) -> DataFrame:
    """Underscores for spaces in the names, declared types for the values; bad values fail."""
    declared = StructType.fromDDL(schema)
    df = df.toDF(*[c.replace(" ", "_") for c in df.columns])

    def cast(field):
        text = F.col(field.name)
        if isinstance(field.dataType, LongType):  # whole numbers may be written as 1.0
            text = text.cast("decimal(38,10)")
        return text.cast(field.dataType).alias(field.name)

    return df.select(*[cast(f) for f in declared.fields])


def ingest_folder(spark: SparkSession, path: str, loaded_at: str, schema: str = fixed.PARAMETER_FILE_SCHEMA, hours: int = 4) -> DataFrame:
    """All CSV files of a folder (not of its subfolders) in the declared types, with the load time.

    Files may hold the columns in different orders; each file's header is its first line, and a later row that repeats it
    is data. Rows without any value are dropped. The files are listed and their headers read when this is called.
    """
    names = [f.name for f in StructType.fromDDL(schema).fields]
    rows = file_rows(spark.read, path, len(names))
    return loaded(aligned_by_name(rows, header_orders(spark, rows.inputFiles(), names), schema), loaded_at, hours)


def read_nested_reviews(spark: SparkSession, path: str, kind: str = "json", partition: str | None = None) -> DataFrame:
    """Products with their list of reviews, from JSON lines or Parquet. ``partition`` declares the folders' column."""
    schema = "omsid long, num_reviews long, reviews array<struct<Id: string, ReviewText: string>>"
    return spark.read.schema(f"{schema}, {partition}" if partition else schema).format(kind).load(path)


def latest_run_dir(df: DataFrame, run_col: str = "run_date") -> DataFrame:
    """Rows of the newest run. On a table partitioned by ``run_col`` only that folder is read."""
    return df.where(F.col(run_col) == df.agg(F.max(run_col)).scalar())


def output_run_name(run_dir: str) -> str:
    """Name of the output folder of an input folder: its first two parts and a suffix."""
    return "_".join(run_dir.split("_")[:2]) + "_extraction_processed"
