"""Order events: JSON text -> typed facts.

A time that is not 12 or 14 digits or not a calendar time is quarantined.
Every JSON field is declared STRING, so ``"12"`` and ``12`` both read as
``'12'``.  ``flag <=> '1'`` decides paid; a missing flag is unpaid but still
counts in ``total``.  Fee is used only for paid orders.  Malformed records
(not JSON, short time, paid without a numeric fee) are quarantined with a
reason rather than failing the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglark.functions.timefmt import day_of, hour_of, minute_of, order_event_time
from loglark.schemas import ORDER_EVENT

REASON_BAD_JSON = "bad_json"
REASON_BAD_TIME = "bad_time"
REASON_BAD_FEE = "bad_fee"

TIME_PATTERN = "^[0-9]{12}([0-9]{2})?$"
_CORRUPT = "_corrupt_record"


def parse_order_json(records: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> the six string fields, ``_reason`` (NULL when good) and
    ``_raw`` (the record's text when it is bad).

    One parse per record: a text that is not a JSON object comes back with
    the corrupt-record field set (or as a NULL struct when empty).  Rows leave
    through a one-row generator, so that a filter on ``_reason`` is not pushed
    below the parse, which would repeat it once per field.
    """
    text = F.col(value_col).cast("string")
    schema = T.StructType(ORDER_EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])
    obj = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    df = records.select(text.alias("_text"), obj.alias("_o"))
    df = df.select(F.inline(F.array(F.struct("_text", "_o")))).select(
        "_text", (F.col("_o").isNull() | F.col(f"_o.{_CORRUPT}").isNotNull()).alias("_bad_json"),
        *[F.col("_o." + f.name).alias(f.name) for f in ORDER_EVENT.fields])
    paid = F.col("flag").eqNullSafe("1")
    fee_num = F.col("fee").try_cast("bigint")
    reason = (
        F.when(F.col("_bad_json"), F.lit(REASON_BAD_JSON))
        .when(order_event_time(F.col("time")).isNull(), F.lit(REASON_BAD_TIME))
        .when(paid & fee_num.isNull(), F.lit(REASON_BAD_FEE))
    )
    df = df.withColumn("_reason", reason)
    return df.withColumn("_raw", F.when(F.col("_reason").isNotNull(), F.col("_text"))).drop("_bad_json", "_text")


def order_facts(parsed: DataFrame) -> DataFrame:
    """Good orders -> day, hour, minute, total(=1), success(0/1), fee (paid only)."""
    paid = F.col("flag").eqNullSafe("1")
    return parsed.where(F.col("_reason").isNull()).select(
        day_of(F.col("time")).alias("day"),
        hour_of(F.col("time")).alias("hour"),
        minute_of(F.col("time")).alias("minute"),
        F.col("time"),
        F.col("orderid"),
        F.lit(1).cast("bigint").alias("total"),
        F.when(paid, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("success"),
        F.when(paid, F.col("fee").try_cast("bigint")).otherwise(F.lit(0)).cast("bigint").alias("fee"),
    )


def quarantined_orders(parsed: DataFrame) -> DataFrame:
    """Bad records: reason, every field that was read, and the whole text."""
    fields = [f.name for f in ORDER_EVENT.fields]
    return parsed.where(F.col("_reason").isNotNull()).select(F.col("_reason").alias("reason"), *fields, F.col("_raw").alias("raw"))
