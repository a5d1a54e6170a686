"""Sharding by global byte-size prefix sums (operator 13).

All rows stand in one order: doc_id (null first), then checksum, size and a hash of the
carried columns.  A range partitioning gives each task a run of that order; the runs'
byte totals (one row per task) are added up to the bytes and rows before each run, and
inside a run a running sum goes on from there.  A row belongs to the shard in which the
middle of its bytes falls when the whole is cut at equal targets, so shards are
contiguous and miss their target by at most half a row at either end.

Only the size, checksum and carried columns of a row are shuffled.  Equal rows are told
apart by their place in the input, so that a doc_id on a third of all rows is cut into
ranges too; which of them comes first changes nothing that is returned.

Defined results: a null text has no bytes and size 1, as has an empty text; its checksum is 0;
null doc_ids come first; a row of more bytes than a shard's target is a shard alone (or with
its neighbours), and shards around it may stay empty; repeated rows are sharded one by one;
an empty table gives an empty result.  ``docs`` may have further columns of any name; those in
``carry`` come back, unless they have the name of a result column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglark.llm.common import quoted, saved, table_files

LAW = "bytes"


def shard_documents(docs: DataFrame, shards: int = 8, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the carried columns, per row."""
    result = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    others = [c for c in carry if c not in result]
    # carried columns travel in one struct, so no name of theirs meets one of ours
    row = F.struct(*[F.col(quoted(c)) for c in others]) if others else F.lit(None).cast("int")
    mark = F.xxhash64(*[F.to_json(F.struct(F.col(quoted(c)).alias("c"))) for c in others]) if others else F.lit(0).cast("long")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    slim = docs.select("doc_id", size.alias("size"), F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).alias("text_crc32"),
                       mark.alias("mark"), F.monotonically_increasing_id().alias("at"), row.alias("row"))
    order = ["doc_id", "text_crc32", "size", "mark", "at"]
    runs = saved(slim.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "shard-runs")
    # one row per task of the range partitioning: few, whatever the number of documents
    totals = runs.groupBy("run").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("run", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
                           F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"))
    within = Window.partitionBy("run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (runs.withColumn("upto", F.sum("size").over(within)).withColumn("nth", F.count(F.lit(1)).over(within))
              .join(F.broadcast(starts), "run"))
    # twice the middle of the row's bytes, in decimals: no product passes its type
    middle = (2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")).cast("decimal(28,0)")
    cut = F.expr("middle div whole").cast("int")
    placed = (placed.withColumn("middle", middle * F.lit(shards).cast("decimal(10,0)"))
              .withColumn("whole", (2 * F.col("all_bytes")).cast("decimal(28,0)")).withColumn("shard", cut)
              .withColumn("place", F.col("rows_before") + F.col("nth") - 1)
              .select("doc_id", "size", "text_crc32", "shard", "place", "row"))
    placed = saved(placed, "shard-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *[F.col("row").getField(c).alias(c) for c in others])


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> DataFrame:
    """The documents with all their columns as Parquet in ``<path>/shard=<i>``, in slot order
    inside each file; returns them as read back."""
    rows = shard_documents(docs, shards, [c for c in docs.columns if c != "doc_id"])
    # the order of slots cuts a shard into files of about equal rows; each file holds one run of slots
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    return table_files(docs.sparkSession, path, rows.schema)
