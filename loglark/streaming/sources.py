"""Streaming sources of order records.

Kafka is the production source; the same downstream code runs over a folder
of JSON-lines files (tests, replays).  Only the raw text ``value`` is read
here; parsing is :mod:`loglark.sources.orders`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def max_offsets_per_trigger(records_per_sec_per_partition: int, interval_sec: int, partitions: int) -> int:
    """A per-partition rate of the old API -> Structured Streaming's cap,
    which is per trigger and over all partitions."""
    return records_per_sec_per_partition * interval_sec * partitions


def order_stream_from_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def order_stream_from_kafka(spark: SparkSession, bootstrap: str, topics: str,
                            starting_offsets: str = "latest", max_offsets: int | None = None,
                            min_partitions: int | None = None) -> DataFrame:
    """Subscribe to ``topics``; ``latest`` applies on the first start
    only, afterwards the checkpoint decides where to resume.

    ``min_partitions`` lets Spark cut a topic partition's offset range into
    several tasks, so one hot Kafka partition does not become one task.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topics)
              .option("startingOffsets", starting_offsets))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")
