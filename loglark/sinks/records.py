"""Record sinks (K7, K8): JSON text files or a Kafka topic, and console output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json_records(df: DataFrame) -> DataFrame:
    """Every row as one JSON object in ``value``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7 (file form): one JSON record per line."""
    to_json_records(df).write.mode(mode).text(path)


def kafka_available(spark) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def write_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    """K7: JSON records to a Kafka topic (needs the Kafka connector jar)."""
    if not kafka_available(df.sparkSession):
        raise RuntimeError("the Kafka connector is not on the classpath")
    (to_json_records(df).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def show(df: DataFrame) -> None:
    """K8: print every row as JSON, a partition at a time (the console sink of the batch jobs)."""
    for row in to_json_records(df).toLocalIterator():
        print(row["value"])
