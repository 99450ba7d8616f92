"""Row numbers and running sums equal a plain computation, whatever the skew and the number of blocks."""

import pytest
from pyspark.sql import functions as F

from fieldtide.operators import ordered


def rows(spark, hot=600, cold=40):
    """Key 1 holds most rows; a NULL key, NULL values and many ties in v are included."""
    data = [(1, None if i % 11 == 0 or i % 7 == 6 else i % 7, i) for i in range(hot)]
    data += [(k, i % 3, 10_000 + k * 100 + i) for k in range(2, 2 + cold) for i in range(5)]
    data += [(None, i, 90_000 + i) for i in range(9)] + [(77, None, 80_000), (77, None, 80_001)]
    return spark.createDataFrame(data, "k int, v int, id int").repartition(6)


def expected(df, keyed):
    data = [tuple(r) for r in df.collect()]
    groups = {}
    for k, v, i in sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])):
        groups.setdefault(k if keyed else 0, []).append((k, v, i))
    out = []
    for group in groups.values():
        total, before = None, None
        for n, (k, v, i) in enumerate(group, 1):
            total = total if v is None else (total or 0) + v
            out.append((k, v, i, n, len(group) - n + 1, total, before))
            before = i
    return sorted(out, key=str)


def order():
    return [F.col("v").desc_nulls_last(), F.col("id")]


@pytest.mark.parametrize("blocks", ["1", "8", "37"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_numbered(spark, keys, blocks):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    try:
        df = rows(spark)
        got = ordered.numbered(df, keys, order(), reverse="rev", sums={"total": "v"}, previous={"before": "id"})
        got = [tuple(r) for r in got.select("k", "v", "id", "ord", "rev", "total", "before").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=str) == expected(df, bool(keys))


def test_sum_is_null_until_there_is_a_value(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, 5)], "k int, o int, v int")
    got = ordered.numbered(df, ["k"], [F.col("o")], sums={"s": "v"}).orderBy("o").collect()
    assert [r.s for r in got] == [None, None, 5]


def test_previous_is_null_kept(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, "c")], "k int, o int, v string")
    got = ordered.numbered(df, ["k"], [F.col("o")], previous={"p": "v"}).orderBy("o").collect()
    assert [r.p for r in got] == [None, "a", None]


def test_numbering_everything_shuffles_once(spark):
    got = ordered.numbered(spark.range(0, 4500).toDF("id"), [], [F.col("id")])
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in text and "CartesianProduct" not in text
    assert [r.ord for r in got.orderBy("id").collect()] == list(range(1, 4501))


def test_no_rows(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert ordered.numbered(df, ["k"], [F.col("v")], sums={"s": "v"}, previous={"p": "v"}, reverse="r").count() == 0
    assert ordered.chunk_numbers(df, [F.col("v")]).count() == 0


def test_chunks_hold_at_most_their_size(spark):
    df = spark.range(0, 4500).select(F.col("id"), F.lit("x").alias("t"))
    sizes = ordered.chunk_numbers(df, [F.col("id")]).groupBy("chunk_no").count().orderBy("chunk_no").collect()
    assert [r["count"] for r in sizes] == [1999, 1999, 502]
