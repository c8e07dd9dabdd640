"""Incremental coarse parse of request-log files with Structured Streaming.

The warehouse itself is a daily batch; this is the stateless part of it (the
coarse parse) run on log files as they land, appending parsed rows to a
``dt``-partitioned table.  No state, no watermark: the invalid-traffic rules
stay in the daily batch (they need the whole day).  The file sink and the
checkpoint (in the shared folder) make the output exactly-once across
restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtrail.fixed import LOG_FIELD_DELIMITER
from adtrail.operators.parse import parse_log
from adtrail.schemas import ODS_AD_LOG
from adtrail.sources.text import split_fields


def parsed_log_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of parsed events; ``dt`` is the arrival day of the
    file (taken from a ``dt=`` folder when present, else today's date)."""
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
           .option("basePath", source_dir).load(source_dir))
    rows = split_fields(raw, ODS_AD_LOG, LOG_FIELD_DELIMITER)
    if "dt" not in rows.columns:
        rows = rows.withColumn("dt", F.date_format(F.current_date(), "yyyy-MM-dd"))
    return parse_log(rows.withColumn("dt", F.col("dt").cast("string")))


def start(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
          available_now: bool = False, processing_time: str = "1 minute") -> StreamingQuery:
    writer = (parsed_log_stream(spark, source_dir).writeStream.format("parquet")
              .option("path", target_dir).option("checkpointLocation", checkpoint_dir)
              .partitionBy("dt").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
