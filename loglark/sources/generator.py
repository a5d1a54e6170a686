"""Synthetic order records.

One order per input row, with fields drawn from a seeded 64-bit hash of the
row id instead of a stateful random generator, so a rerun or a retried task
produces the same records: userid 0-999, courseid 0-499, fee 0-399, flag 0/1,
a UUID-shaped order id, and the row's time as ``yyyyMMddHHmmss``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _draw(seed: int, salt: int, key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), key), F.lit(n)).cast("string")


def _uuid_like(seed: int, key: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def order_fields(rows: DataFrame, seed: int, key_col: str, time_col: Column) -> DataFrame:
    key = F.col(key_col)
    return rows.select(
        F.date_format(time_col, "yyyyMMddHHmmss").alias("time"),
        _draw(seed, 1, key, 1000).alias("userid"),
        _draw(seed, 2, key, 500).alias("courseid"),
        _uuid_like(seed, key).alias("orderid"),
        _draw(seed, 3, key, 400).alias("fee"),
        _draw(seed, 4, key, 2).alias("flag"),
    )


def generate_orders(rows: DataFrame, seed: int = 42, key_col: str = "event_id", time_col: str = "ts") -> DataFrame:
    """One JSON order record (``value``) per row of ``rows``."""
    f = order_fields(rows, seed, key_col, F.col(time_col))
    return f.select(F.to_json(F.struct(*f.columns)).alias("value"))


def generate_order_stream(spark: SparkSession, rows_per_second: int, seed: int = 42) -> DataFrame:
    """Streaming form on the ``rate`` source: ``now`` as the order time (P20)."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    f = order_fields(rate, seed, "value", F.col("timestamp"))
    return f.select(F.to_json(F.struct(*f.columns)).alias("value"))
