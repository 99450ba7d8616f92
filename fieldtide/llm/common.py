"""Helpers shared by the operators: words, scratch tables, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (spark.checkpoint.dir).

    Where that is unset, as in tests, the warehouse folder serves instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    scratch(df.sparkSession, "")
    return df.checkpoint()


def components(edges: DataFrame, a: str = "a", b: str = "b", random_nodes: bool = False) -> DataFrame:
    """Connected components as (node, component): the smallest node that can be reached.

    Each round maps every node to the smallest of itself and its neighbours and keeps the distinct
    edges between different images, so stars vanish in one round and paths shrink by a constant
    factor, as nodes are compared by a hash (ids in order along a path would shrink by one). Nodes that
    are random already, such as digests, are compared as they are with ``random_nodes``.
    Hot nodes are only ever aggregated or joined, never gathered.
    """
    if not random_nodes:
        hashed = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id")))
        found = components(edges.select(hashed(a).alias("a"), hashed(b).alias("b")), random_nodes=True)
        least = found.groupBy("component").agg(F.min("node.id").alias("least"))
        return found.join(least, "component").select(F.col("node.id").alias("node"), F.col("least").alias("component"))
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    e = checkpointed(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = e.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    while not e.isEmpty():
        small = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        small = checkpointed(small)
        left, right = small.toDF("a", "ma"), small.toDF("b", "mb")
        e = checkpointed(
            e.join(left, "a").join(right, "b").where("ma <> mb")
            .select(F.col("ma").alias("a"), F.col("mb").alias("b")).distinct()
        )
        labels = checkpointed(
            labels.join(small.toDF("component", "m"), "component", "left")
            .select("node", F.coalesce("m", "component").alias("component"))
        )
    return labels
