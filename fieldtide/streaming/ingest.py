"""Folder pick-up as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldtide.functions import fixed_values as fixed
from fieldtide.sources.tables import aligned_by_name, file_rows, header_orders, loaded


def ingest_folder_stream(
    spark: SparkSession, path: str, width: int, archive_dir: str, checkpoint: str, out: str, loaded_at: str,
    schema: str = fixed.PARAMETER_FILE_SCHEMA, hours: int = 4,
) -> StreamingQuery:
    """Append the new files of a folder of ``width`` columns to a Parquet table, then stop.

    Every file is read once, also after a restart, and its values go by the names in its own header,
    whatever their order. A batch replaces its own folder ``batch=<n>``, so a repeated batch adds nothing
    twice. Files move to ``archive_dir`` when the next run has seen that they are done.
    """
    reader = spark.readStream.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = file_rows(reader, path, width)
    names = [f.name for f in StructType.fromDDL(schema).fields]

    def write(batch: DataFrame, number: int) -> None:
        taken = [row["_file"] for row in batch.select("_file").distinct().collect()]
        rows = aligned_by_name(batch, header_orders(spark, taken, names), schema)
        loaded(rows, loaded_at, hours).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
