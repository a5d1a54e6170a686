"""Sorting and ranking.

``global_row_number`` numbers rows in a total order without moving all rows
into one partition (what ``row_number() OVER (ORDER BY ...)`` does):

1. range-partition on the order keys and sort inside partitions;
2. cut lineage with a reliable checkpoint so both uses below see the same
   partitions (it also survives a lost executor);
3. ``monotonically_increasing_id`` gives (partition, position) for free;
4. per-partition counts (one row per partition, a bounded table) give the
   offsets, which are broadcast back.

The order must be total (end it with a unique column) so ties cannot make
the numbering depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglark.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn",
                      partitions: int | None = None, presorted: bool = False) -> DataFrame:
    """``presorted``: ``df`` is range-partitioned and sorted by ``order`` already."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df if presorted else df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stable = ranged.checkpoint(eager=True)
    with_id = stable.withColumn("_mid", F.monotonically_increasing_id())
    with_id = with_id.withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS)) \
                     .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1))
    counts = with_id.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    out = with_id.join(F.broadcast(offsets), "_pid", "left")
    return out.select(*[F.col(c) for c in df.columns],
                      (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1).cast("bigint").alias(name))


# P17: "name price store" -> typed product rows.
def parse_products(lines: DataFrame, value_col: str = "value") -> DataFrame:
    parts = F.split(F.col(value_col), " ", -1)
    return lines.select(
        F.get(parts, 0).alias("name"),
        F.get(parts, 1).try_cast("int").alias("price"),
        F.get(parts, 2).try_cast("int").alias("store"),
    )


def product_string(df: DataFrame) -> Column:
    """``ProductClass(name, price, store)``."""
    return F.format_string("ProductClass(%s, %d, %d)", F.col("name"), F.col("price"), F.col("store"))


def sort_price_store(products: DataFrame) -> list[Column]:
    """O2 (the intended order): price desc, then stock desc; name breaks ties."""
    return [F.desc_nulls_last("price"), F.desc_nulls_last("store"), F.asc_nulls_last("name")]


def sort_price(products: DataFrame) -> list[Column]:
    """O3/O4 (the live order): price desc only, name as explicit tie-break."""
    return [F.desc_nulls_last("price"), F.asc_nulls_last("name")]


def ranked_products(products: DataFrame, mode: str = "price_store") -> DataFrame:
    order = sort_price_store(products) if mode == "price_store" else sort_price(products)
    out = products.withColumn("descr", product_string(products))
    return global_row_number(out, order, "rn")
