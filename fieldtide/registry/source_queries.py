"""Reading and writing: every query passes the test tables through files and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldtide.adapters import Tables
from fieldtide.functions import fixed_values as fixed
from fieldtide.operators.reviews import explode_reviews
from fieldtide.plans.steps import Step, run_steps
from fieldtide.registry.core import query
from fieldtide.registry.text_queries import products
from fieldtide.session import scratch_path
from fieldtide.sources import sinks, tables
from fieldtide.streaming import ingest, recipients


@query("scan_table", "select o_orderkey, o_totalprice from orders where o_totalprice > 200000")
def scan(t):
    t.table("orders").createOrReplaceTempView("fieldtide_orders")
    return tables.scan_table(t.spark, "select o_orderkey, o_totalprice from fieldtide_orders where o_totalprice > :least", {"least": 200000})


SERIES_SCHEMA = "yr int, mo int, ds date, y bigint, series string, qtr int, moq int"


@query("read_headerless_csv", "select yr::int yr, mo::int mo, ds, y, series, quarter(ds)::int qtr, ((mo - 1) % 3 + 1)::int moq from fx_series", views=["fx_series"], texts=["ds"])
def headerless(t):
    path = scratch_path(t.spark, "series")
    rows = t.fx("fx_series").select("yr", "mo", "ds", "y", "series", F.quarter("ds").alias("qtr"), ((F.col("mo") - 1) % 3 + 1).alias("moq"))
    rows.write.csv(path, header=False)
    return tables.read_headerless_csv(t.spark, path, SERIES_SCHEMA)


@query("read_headered_csv", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def headered(t):
    path = scratch_path(t.spark, "customers")
    t.table("customer").write.csv(path, header=True)
    return tables.read_headered_csv(t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


def _file_names() -> list[str]:
    return [part.strip().split(" ")[0] for part in fixed.PARAMETER_FILE_SCHEMA.split(",")]


def _write_params(t: Tables, path: str) -> None:
    """Parameter files with blanks in the header, some with the columns in another order."""
    header = [name.replace("_", " ") for name in _file_names()]
    rows = t.fx("fx_params").toDF(*header)
    late = F.col("Param Desc") == "O"
    rows.where(late).write.csv(path, header=True)
    rows.where(~late).select(*[F.col(f"`{c}`") for c in reversed(header)]).write.mode("append").csv(path, header=True)


PARAMS_SQL = "select " + ", ".join(
    f"cast({n.lower()} as {'bigint' if n in ('Trumping_Level', 'Type', 'Parm_code') else 'varchar' if n in ('Velocity_Id', 'Eff_Begin_date', 'Eff_End_date', 'Param_Desc', 'OOTL_Reason_Code') else 'double'}) \"{n}\""
    for n in _file_names()) + ", '2024-02-05 04:00:00' \"time\" from fx_params"


@query("ingest_folder", PARAMS_SQL, views=["fx_params"])
def folder(t):
    path = scratch_path(t.spark, "params")
    _write_params(t, path)
    rows = tables.ingest_folder(t.spark, path, "2024-02-05 00:00:00")
    return rows.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))


@query("ingest_folder_stream", PARAMS_SQL, views=["fx_params"])
def folder_stream(t):
    path, out = scratch_path(t.spark, "params"), scratch_path(t.spark, "ingested")
    _write_params(t, path)
    ingest.ingest_folder_stream(
        t.spark, path, len(_file_names()), scratch_path(t.spark, "archive"), scratch_path(t.spark, "offsets"), out, "2024-02-05 00:00:00"
    ).awaitTermination()
    return t.spark.read.parquet(out).drop("batch").withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))


@query("read_nested_reviews", """select conv_id omsid, count(*) num_reviews, count(*) listed, count(case when turn % 7 <> 3 then 1 end) with_text
 from conversations group by 1""")
def nested(t):
    path = scratch_path(t.spark, "reviews")
    products(t).write.json(path)
    rows = tables.read_nested_reviews(t.spark, path)
    return rows.select("omsid", "num_reviews", F.size("reviews").cast("long").alias("listed"),
                       F.size(F.filter("reviews", lambda r: r["ReviewText"].isNotNull())).cast("long").alias("with_text"))


@query("latest_run_dir", "select o_orderkey, strftime(o_orderdate, '%Y%m') run_date from orders where strftime(o_orderdate, '%Y%m') = (select max(strftime(o_orderdate, '%Y%m')) from orders)")
def latest_run(t):
    """From a folder per month; only the newest is read."""
    path = scratch_path(t.spark, "runs")
    rows = t.table("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("run_date"))
    rows.repartition("run_date").write.partitionBy("run_date").parquet(path)
    return tables.latest_run_dir(t.spark.read.schema(rows.schema).parquet(path))


@query("write_overwrite", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def overwrite(t):
    path = scratch_path(t.spark, "supplier")
    sinks.write_overwrite(t.table("nation"), path)
    return sinks.write_overwrite(t.table("supplier"), path)


@query("export_csv_dated", "select 'nation' src, n_nationkey::bigint k, n_name n from nation union all select 'supplier', s_suppkey, s_name from supplier")
def dated(t):
    paths = sinks.export_csv_dated({n: t.table(n) for n in ("nation", "supplier")}, scratch_path(t.spark, "export"), "20240205")
    nation, supplier = (t.spark.read.csv(p, header=True) for p in paths)
    rows = nation.select(F.lit("nation").alias("src"), F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("n"))
    return rows.union(supplier.select(F.lit("supplier"), F.col("s_suppkey").cast("long"), "s_name"))


@query("export_csv_chunked_files", """select cast(ceil(n / 1999.0) as bigint) chunk_no, count(*) n_rows, sum(k)::bigint keys from
 (select o_orderkey k, row_number() over (order by o_orderkey) n from orders) x group by 1""")
def chunk_files(t):
    path = sinks.export_csv_chunked(t.table("orders"), [F.col("o_orderkey")], scratch_path(t.spark, "chunks"), "20240205")
    rows = sinks.chunk_files(t.spark, path, t.table("orders").schema.simpleString()[7:-1].replace(":", " "))
    return rows.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"))


def _recipients(t):
    return t.fx("fx_results").withColumnRenamed("user_id", "user").withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))


RECENT = "run_ts >= timestamp '2024-01-30 23:05:00' - interval 10 minute"


@query("recent_recipients", f"select distinct user_id as user, mail, run_ts from fx_results where {RECENT}", views=["fx_results"], texts=["run_ts"])
def recent(t):
    return recipients.recent_recipients(_recipients(t), "2024-01-30 23:05:00")


@query("recent_recipients_stream", """select distinct user_id as user, event_type mail, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') run_ts from events""")
def recent_stream(t):
    source = t.table("events")
    stream = t.spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    rows = stream.select(F.col("user_id").alias("user"), F.col("event_type").alias("mail"), F.date_trunc("hour", "ts").alias("run_ts"))
    out = scratch_path(t.spark, "recipients")
    recipients.recent_recipients_stream(rows).writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(t.spark, "offsets")).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out).withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss"))


@query("export_by_recipient", f"""select user_id as user, event_id, value from fx_results where (user_id, run_ts) in
 (select user_id, run_ts from fx_results where {RECENT})""", views=["fx_results"])
def by_recipient(t):
    rows, out = _recipients(t), scratch_path(t.spark, "recipients")
    sinks.export_by_recipient(rows, recipients.recent_recipients(rows, "2024-01-30 23:05:00"), out)
    schema = "mail string, value double, event_id long, user long, run_ts string"
    return t.spark.read.csv(out, header=True, schema=schema).select("user", "event_id", "value")


@query("report_lines", """select * from (select 1 line_no, null c1, 'Fall Off Report' c2, null c3 union all select 2, null, 'by Region', null union all select 3, null, '', null
 union all select 3 + row_number() over (order by r_name, n_name), r_name, n_name, cast(n_nationkey as varchar) from nation join region on n_regionkey = r_regionkey) x""")
def lines(t):
    regions = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    body = t.table("nation").join(regions, "n_regionkey").select("r_name", "n_name", "n_nationkey")
    return sinks.report_lines(body, ["Fall Off Report", "by Region", ""], [F.col("r_name"), F.col("n_name")])


@query("review_output", "select conv_id omsid, cast(turn % 4 as varchar) review_id, arg_max(text, turn) review_text from conversations where turn % 7 <> 3 group by 1, 2")
def review_out(t):
    path = scratch_path(t.spark, "reviews")
    sinks.review_output(explode_reviews(products(t)), path)
    return t.spark.read.parquet(path)


@query("run_steps", """s as (select o_custkey, o_orderstatus, sum(o_totalprice) amount, count(*) n from orders group by 1, 2)
---select c_mktsegment segment, o_orderstatus, sum(amount) amount, sum(n)::bigint n, '20240205' run_date from s join customer on c_custkey = o_custkey group by 1, 2""", digits={"amount": 2})
def steps(t):
    for name in ("orders", "customer"):
        t.table(name).createOrReplaceTempView(f"fieldtide_{name}")
    listed = [
        Step(1, "select c_mktsegment segment, o_orderstatus, sum(amount) amount, sum(n) n, '{RUN_DATE}' run_date from {STAGING}_status_{RUN_DATE}"
                " join fieldtide_customer on c_custkey = o_custkey group by 1, 2", "{REPORTING}_segments"),
        Step(0, "select o_custkey, o_orderstatus, sum(o_totalprice) amount, count(*) n from fieldtide_orders group by 1, 2", "{STAGING}_status_{RUN_DATE}"),
    ]
    params = {"STAGING": "stage", "REPORTING": "report", "RUN_DATE": "RESOLVE:select replace(cast(date '2024-02-05' as string), '-', '')"}
    return run_steps(t.spark, listed, params, scratch_path(t.spark, "steps"))["report_segments"]
