"""Incremental bronze ingestion.

The batch bronze layer (``plans.medallion.bronze``) copies a source table
and adds lineage columns. This is the same step as a Structured Streaming
query: new files under ``source_path`` are picked up once, stamped with
lineage columns and appended to ``sink_path``. Progress lives in
``checkpoint_path`` (a shared folder), so a restarted or retried job
resumes exactly where it stopped; ``availableNow`` processes the backlog
and stops, which suits scheduled runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def bronze_stream(spark: SparkSession, source_path: str, schema: T.StructType | str,
                  sink_path: str, checkpoint_path: str, source_system: str,
                  source_table: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stamped = reader.load(source_path).withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_system": F.lit(source_system),
        "source_table": F.lit(source_table),
        "source_file": F.col("_metadata.file_path"),
    })
    writer = (stamped.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
