"""Incremental ingest: a folder of BED12 files as a stream, appended to the call table batch by batch.

The consensus itself is a batch computation over all calls of a sample; nothing here windows or keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arcloom.sources.bed import parse_bed12


def ingest_bed12(spark: SparkSession, folder: str, table_path: str, checkpoint: str, tool_pattern: str = r"([^/.]+)\.[^/]*$") -> StreamingQuery:
    """Parse every new file of ``folder`` once and append its calls to the Parquet table; the caller's name is in the file name.

    A batch that is run again replaces what its first run wrote (one sub-folder per batch), so calls are not doubled.
    """
    lines = spark.readStream.text(folder).select("value", F.col("_metadata.file_path").alias("file"))

    def put(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("ord", F.monotonically_increasing_id())
        calls = parse_bed12(rows, F.regexp_extract("file", tool_pattern, 1))
        calls.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return lines.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
