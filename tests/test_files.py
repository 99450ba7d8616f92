"""Files: folders, streams, chunks and steps."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldtide.plans.steps import Step, fill, run_steps
from fieldtide.sources import sinks, tables
from fieldtide.streaming.ingest import ingest_folder_stream
from fieldtide.streaming.recipients import recent_recipients, recent_recipients_stream

SCHEMA = "Type bigint, Store double, Param_Desc string"


def put(folder: Path, name: str, *lines: str, header: str = "Type,Store,Param Desc") -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_ingest_folder(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "1,2.5,x", ",,")
    put(folder, "b.csv", "2.0,,y")
    (folder / "Archive").mkdir()
    put(folder / "Archive", "old.csv", "9,9,z")
    got = tables.ingest_folder(spark, str(folder), "2024-01-01 22:30:00", SCHEMA).orderBy("Type").collect()
    assert [(r.Type, r.Store, r.Param_Desc, str(r.time)) for r in got] == [
        (1, 2.5, "x", "2024-01-02 02:30:00"), (2, None, "y", "2024-01-02 02:30:00")]


@pytest.mark.parametrize("line, header", [("oops,1,x", "Type,Store,Param Desc"), ("1,1,x", "Shop,Type,Param Desc"), ("1,1", "Type,Store")])
def test_ingest_folder_fails_on_bad_files(spark, tmp_path, line, header):
    folder = tmp_path / "in"
    put(folder, "a.csv", "1,2.5,x", *["1,2,x"] * 50)
    put(folder, "b.csv", line, header=header)
    with pytest.raises(Exception):
        tables.ingest_folder(spark, str(folder), "2024-01-01 00:00:00", SCHEMA).collect()


def test_stream_takes_each_file_once_and_archives_late(spark, tmp_path):
    folder, archive, out = tmp_path / "in", tmp_path / "archive", tmp_path / "out"

    def run():
        ingest_folder_stream(spark, str(folder), 3, str(archive), str(tmp_path / "offsets"), str(out),
                             "2024-01-01 00:00:00", SCHEMA).awaitTermination()
        return sorted(r.Type for r in spark.read.parquet(str(out)).collect())

    put(folder, "a.csv", "1,1,x")
    assert run() == [1]
    assert run() == [1]
    put(folder, "b.csv", "2,1,x")
    assert run() == [1, 2]
    put(folder, "c.csv", "3,1,x")
    assert run() == [1, 2, 3]
    assert [p.name for p in archive.rglob("*.csv") if p.name == "a.csv"] == ["a.csv"]


def test_columns_go_by_name_in_any_order(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "1,2.5,x", ",,")
    put(folder, "b.csv", "y,7,2.0", header="Param Desc,Type,Store")
    want = [(1, 2.5, "x"), (7, 2.0, "y")]
    batch = tables.ingest_folder(spark, str(folder), "2024-01-01 00:00:00", SCHEMA)
    ingest_folder_stream(spark, str(folder), 3, str(tmp_path / "archive"), str(tmp_path / "offsets"), str(tmp_path / "out"),
                         "2024-01-01 00:00:00", SCHEMA).awaitTermination()
    for rows in (batch, spark.read.parquet(str(tmp_path / "out"))):
        assert sorted(tuple(r) for r in rows.select("Type", "Store", "Param_Desc").collect()) == want


def test_repeated_header_rows_are_data_and_empty_files_have_none(spark, tmp_path):
    folder, schema = tmp_path / "in", "a string, b string"
    put(folder, "one file.csv", "1,2", "a,b", "3,4", header="a,b")
    put(folder, "two.csv", "6,5", "b,a", header="b,a")
    (folder / "none.csv").write_text("")
    got = tables.ingest_folder(spark, str(folder), "2024-01-01 00:00:00", schema)
    want = [("1", "2"), ("3", "4"), ("5", "6"), ("a", "b"), ("a", "b")]
    assert sorted((r.a, r.b) for r in got.collect()) == want
    ingest_folder_stream(spark, str(folder), 2, str(tmp_path / "archive"), str(tmp_path / "offsets"), str(tmp_path / "out"),
                         "2024-01-01 00:00:00", schema).awaitTermination()
    assert sorted((r.a, r.b) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == want


def test_headerless_csv_is_strict(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("2019,1,a\n2019,x,b\n")
    with pytest.raises(Exception):
        tables.read_headerless_csv(spark, str(path), "yr int, mo int, s string").collect()


def test_chunk_files(spark, tmp_path):
    path = sinks.export_csv_chunked(spark.range(0, 25).repartition(5), [F.col("id").desc()], str(tmp_path), "20240101", 10)
    assert sorted(len(f.read_text().split()) - 1 for f in Path(path).glob("*.csv")) == [5, 10, 10]
    assert not [p for p in Path(path).iterdir() if p.is_dir()]
    rows = sinks.chunk_files(spark, path, "id long").collect()
    assert {(r.id, r.chunk_no) for r in rows} == {(i, (24 - i) // 10 + 1) for i in range(25)}


def test_report_lines(spark):
    body = spark.createDataFrame([("b", 2), ("a", 1)], "x string, n int")
    got = [tuple(r) for r in sinks.report_lines(body, ["Title", ""], [F.col("x")]).collect()]
    assert got == [(1, None, "Title"), (2, None, ""), (3, "a", "1"), (4, "b", "2")]


def test_steps_run_in_order_and_replace_their_target(spark, tmp_path):
    steps = [Step(1, "select n + 1 n from {DS}_a", "{DS}_b"), Step(0, "select 1 n", "{DS}_a")]
    for _ in range(2):
        done = run_steps(spark, steps, {"DS": "RESOLVE:select 'x'"}, str(tmp_path))
    assert done["x_b"].first()["n"] == 2 and spark.read.parquet(str(tmp_path / "x_b")).count() == 1
    with pytest.raises(KeyError):
        fill("{OTHER}", {})


def test_latest_run_dir(spark, tmp_path):
    df = spark.sql("select * from values ('20240101', 1), ('20240301', 2), ('20240301', 3) t(run_date, n)")
    assert sorted(r.n for r in tables.latest_run_dir(df).collect()) == [2, 3]
    df.write.partitionBy(*[c for c in df.columns if c != "n"]).parquet(f"{tmp_path}/runs")
    pruned = tables.latest_run_dir(spark.read.parquet(f"{tmp_path}/runs"))
    assert sorted(r.n for r in pruned.collect()) == [2, 3]
    scan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in scan and "Subquery" in scan
    assert tables.output_run_name("20240301_food_extraction") == "20240301_food_extraction_processed"


def test_recent_recipients(spark):
    df = spark.sql("""select * from values ('u', 'm', timestamp_ntz'2024-01-01 09:55:00'), ('u', 'm', timestamp_ntz'2024-01-01 09:55:00'),
        ('v', 'm', timestamp_ntz'2024-01-01 09:49:59') t(user, mail, run_ts)""")
    assert [r.user for r in recent_recipients(df, "2024-01-01 10:00:00").collect()] == ["u"]


def test_recipients_stream_forgets_old_runs_and_keeps_late_ones(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "user string, mail string, run_ts timestamp"

    def run(n, *lines, keep="1 day"):
        (folder / f"{n}.csv").write_text("\n".join(lines) + "\n")
        stream = spark.readStream.schema(schema).csv(str(folder))
        query = recent_recipients_stream(stream, keep=keep).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start(str(tmp_path / "out"))
        assert query.awaitTermination(60)
        state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return sorted((r.user, str(r.run_ts)[11:16]) for r in spark.read.parquet(str(tmp_path / "out")).collect()), state

    first = ["ann,a@x,2024-01-01 10:00:00", "ann,a@x,2024-01-01 10:00:00", "bob,b@x,2024-01-01 10:05:00"]
    assert run("a", *first)[0] == [("ann", "10:00"), ("bob", "10:05")]
    # A replay adds nothing; rows of any age that are new come through.
    assert run("b", *first, "cyd,c@x,2020-01-01 09:30:00") == ([("ann", "10:00"), ("bob", "10:05"), ("cyd", "09:30")], 3)
    run("c", "dan,d@x,2024-01-01 11:00:00", keep="1 second")
    time.sleep(2)
    assert run("d", "eve,e@x,2024-01-01 11:00:00", keep="1 second")[1] == 4  # ann, bob, cyd and eve; not dan
    # What was kept for a second is forgotten: the same run is handed on again, and not lost.
    assert run("e", "dan,d@x,2024-01-01 11:00:00", keep="1 second")[0].count(("dan", "11:00")) == 2


def test_small_extracts_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select((F.col("id") % 60).alias("user"), F.lit("2024-01-01").alias("run_ts"), "id")
    sinks.export_by_recipient(rows, rows.where("user < 50"), str(tmp_path / "small"))
    names = [f.name[:10] for f in (tmp_path / "small").rglob("part-*.csv")]
    assert len(names) == 50 and len(set(names)) > 1
    monkeypatch.setattr(sinks, "LARGE", 20)
    one = rows.withColumn("user", F.lit(1))
    sinks.export_by_recipient(one, one, str(tmp_path / "large"))
    assert len(list((tmp_path / "large").rglob("part-*.csv"))) > 1
    assert sorted(r.id for r in spark.read.csv(str(tmp_path / "large"), header=True, inferSchema=True).collect()) == list(range(300))
