"""The record path as a stream: validate, keep the first of each job within the registry's time, count by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from careerlake.operators.records import validate


def stream_jsonl(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def first_seen_stream(jobs: DataFrame, ttl: str = "60 days") -> DataFrame:
    """Valid records with the first of each job_hash while state is kept; state goes when the watermark passes scraped_at + ttl."""
    timed = validate(jobs).filter("record_status = 'valid'").withColumn("seen_at", F.to_timestamp("scraped_at"))
    return timed.withWatermark("seen_at", ttl).dropDuplicatesWithinWatermark(["job_hash"])


def windowed_counts(jobs: DataFrame, width: str = "24 hours", late: str = "1 hour") -> DataFrame:
    """Records by window, portal and status; rows later than the watermark are left out."""
    timed = validate(jobs).withColumn("seen_at", F.to_timestamp("scraped_at")).withWatermark("seen_at", late)
    return timed.groupBy(F.window("seen_at", width).alias("w"), "portal_key", "record_status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "portal_key", "record_status", "n")


def run_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes all that is there now as Parquet, exactly once, and stops."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
