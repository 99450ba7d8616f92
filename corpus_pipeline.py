"""The corpus pipeline: quality, near duplicates, benchmark leaks, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and is written as Parquet and
read again as the docs of the next. Rows of a null text are low quality only if the network says so; an empty table
stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtide.llm import classifier, decontamination, mixing, near_dedup, sharding
from fieldtide.llm.common import scratch, stored, table

THRESHOLD = 0.3


CORE = ("doc_id", "text", "lang", "source")


def sheltered(stage):
    """The stage with all columns but those of CORE under names of their own, so that none clashes with what it adds.

    They come back under their old names. A column that is named like a new one of the stage, such as shard, comes back
    as ``<name>_before``.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in CORE else f"_extra{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*names), sf_dir)
        added = [c for c in out.columns if c not in names]
        old = [f"{c}_before" if c in added else c for c in docs.columns]
        return out.select(*names, *added).toDF(*old, *added)

    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


@sheltered
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on the labelled rows of the input."""
    scored = classifier.classify(docs, table(spark, sf_dir, "labels"), threshold=THRESHOLD)
    return scored.where("predicted = 1").select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number each, stored so that every later read sees the same numbers."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")


@sheltered
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that with the smallest id (null last), text hash and place in the
    table. Rows without words stay."""
    rows = numbered(docs)
    found = near_dedup.near_duplicates(rows, root=True).where("root is not null")
    found = stored(found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "near-rows")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"))
    found = found.join(best, "root").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash")))
    gone = found.where("not stays").select("doc_id", "text_hash", F.lit(-1).cast("long").alias("_first"))
    # Rows that repeat id and text: all but the first go.
    keys = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "_row")
    again = found.where("stays and n > 1").select(F.col("doc_id").alias("_again"), F.col("text_hash").alias("_hash"))
    repeated = keys.join(again.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_again")) & (F.col("text_hash") == F.col("_hash")), "left_semi")
    gone = gone.unionByName(repeated.groupBy("doc_id", "text_hash").agg(F.min("_row").alias("_first"))).withColumnRenamed("doc_id", "_gone")
    # The list grows with the documents, so it is merged at every size.
    same = F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.xxhash64("text") == F.col("text_hash")) & (F.col("_row") > F.col("_first"))
    return rows.join(gone.hint("merge"), same, "left_anti").select(*docs.columns)


@sheltered
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@sheltered
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, also where ids repeat or are null."""
    rows = numbered(docs)
    copies = mixing.mix(rows, row="_row").where("copies > 0").select("_row", "copies")
    joined = rows.join(copies, "_row")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


@sheltered
def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place in the shard."""
    return sharding.shard(docs).select(*docs.columns, "shard", "slot")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mixed), ("sharding", sharded)]

# The classifier, the sketches and the draws cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
