"""Event topics: a Kafka topic, or files that hold the same columns.

Every reader here yields ``key`` and ``value`` as text and ``timestamp``, the arrival time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_COLUMNS = "key string, value string, timestamp timestamp_ntz"


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Stream of one topic. Needs the Kafka connector on the class path; offsets live in the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        F.to_timestamp_ntz(F.col("timestamp").cast("string")).alias("timestamp"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def read_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of topic files, oldest file first."""
    reader = spark.readStream.schema(TOPIC_COLUMNS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def write_topic_files(messages: DataFrame, path: str) -> None:
    messages.select("key", "value", "timestamp").write.mode("append").parquet(path)
