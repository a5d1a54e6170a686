"""Schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values (must equal the source system's): the parsed log row's column
# names, the 15 stored qualifiers and their family.  Every field is text; the
# spelling ``protocal`` is kept on purpose.
# The parsed log row.
PARSED_LOG_FIELDS = [
    "ip", "country", "province", "city", "time", "method", "url", "protocal",
    "status", "bytessent", "referer", "browsername", "browserversion",
    "osname", "osversion", "ua",
]
PARSED_LOG = T.StructType([T.StructField(c, T.StringType()) for c in PARSED_LOG_FIELDS])

# The 15 qualifiers stored per row in family ``o`` (``ua`` and raw ``time``
# are not stored; ``formattime`` is).
STORED_FIELDS = [
    "ip", "country", "province", "city", "formattime", "method", "url",
    "protocal", "status", "bytessent", "referer", "browsername",
    "browserversion", "osname", "osversion",
]
ACCESS_FAMILY = "o"

# Day table (D6): rowkey + 15 stored columns, partitioned by day.
ACCESS_TABLE = T.StructType(
    [T.StructField("rowkey", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in STORED_FIELDS]
    + [T.StructField("hits", T.LongType())]
)
ACCESS_TABLE_WITH_DAY = T.StructType(ACCESS_TABLE.fields + [T.StructField("day", T.StringType())])

# One versioned cell.
CELL = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Order event, every field read as text.
ORDER_EVENT = T.StructType([
    T.StructField(c, T.StringType())
    for c in ["time", "userid", "courseid", "orderid", "fee", "flag"]
])

# Counters.
COUNTER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])
COUNTER_HASH = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.LongType()),
])

# Per-batch counter deltas at minute grain (the stored form behind D13/D14).
ORDER_DELTA = T.StructType([
    T.StructField("day", T.StringType()),
    T.StructField("hour", T.StringType()),
    T.StructField("minute", T.StringType()),
    T.StructField("total", T.LongType()),
    T.StructField("success", T.LongType()),
    T.StructField("fee", T.LongType()),
])

# Result table.
BROWSER_STAT = T.StructType([
    T.StructField("day", T.StringType(), False),
    T.StructField("browser", T.StringType(), False),
    T.StructField("cnt", T.LongType()),
])

# Product.
PRODUCT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("store", T.IntegerType()),
])

# Geo ranges (FIXTURES §4): inclusive, non-overlapping.
GEO_RANGE = T.StructType([
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
])
