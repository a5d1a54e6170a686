"""Looking into a stopped or running stream (X8): its state, batches and watermark.

The state of the window queries is read through Spark's ``statestore`` and
``state-metadata`` sources, so the current value of every open window needs no folder
per batch; the batches and the watermark come from the checkpoint's own logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.functions.timefmt import wall_clock
from loglark.streaming.windows import WINDOW_FORMAT

WINDOW_OPERATOR, DEDUP_OPERATOR = "stateStoreSave", "dedupeWithinWatermark"


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operatorId, operatorName, numPartitions, first and last batch with state."""
    return spark.read.format("state-metadata").load(checkpoint)


def _operator_state(spark: SparkSession, checkpoint: str, name: str, batch_id: int | None) -> DataFrame:
    found = [r["operatorId"] for r in state_operators(spark, checkpoint).where(F.col("operatorName") == name).collect()]
    if len(found) != 1:
        raise ValueError(f"{checkpoint} has {len(found)} operators {name}")
    reader = spark.read.format("statestore").option("operatorId", found[0])
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def window_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The open windows of ``start_windowed_orders`` after a batch (the last one when absent):
    window_start, window_end, total, success, fee.  Windows behind the watermark have left the state."""
    state = _operator_state(spark, checkpoint, WINDOW_OPERATOR, batch_id)
    # the three sums carry one name in the state schema: named by position
    sums = F.col("value").cast("struct<total: bigint, success: bigint, fee: bigint>")
    text = lambda c: F.date_format(wall_clock(F.col(c), "UTC"), WINDOW_FORMAT)
    return (state.select(text("key.window.start").alias("window_start"), text("key.window.end").alias("window_end"), sums.alias("s"))
                 .select("window_start", "window_end", "s.total", "s.success", "s.fee"))


def seen_orders(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The order ids that dedup remembers, and when each is forgotten: orderid, expires."""
    state = _operator_state(spark, checkpoint, DEDUP_OPERATOR, batch_id)
    return state.select("key.orderid", F.timestamp_micros("value.expiresAtMicros").alias("expires"))


def batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch_id, the watermark it ran with (ms; 0 before the first), and whether it has committed."""
    def log(name: str) -> DataFrame:
        files = spark.read.schema("value string").text(f"{checkpoint.rstrip('/')}/{name}/[0-9]*", wholetext=True)
        return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).cast("bigint").alias("batch_id"), "value")

    planned = log("offsets").select("batch_id", F.regexp_extract("value", r'"batchWatermarkMs":(\d+)', 1).cast("bigint").alias("watermark_ms"))
    done = log("commits").select("batch_id", F.lit(True).alias("committed"))
    return planned.join(done, "batch_id", "left").select("batch_id", "watermark_ms", F.coalesce("committed", F.lit(False)).alias("committed"))
