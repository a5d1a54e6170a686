"""IP -> country, province, city by address range.

A pure range condition would make Spark pick a nested-loop join.  Ranges are
instead cut into /16 buckets (``ip div 65536``): each range is exploded to the
buckets it touches, and the join is an equi join on the bucket with the range
test as residual condition.  For non-overlapping ranges the exploded table has
at most ``#ranges + 65536`` rows whatever the data size, which is the proven
bound behind the broadcast; if it is still over the limit the join shuffles on
the bucket (AQE splits a hot bucket).  Left outer: an unmatched or malformed
ip keeps its row with NULL geo columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglark.functions.ipaddr import ip_to_long
from loglark.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from loglark.session import ensure_checkpoint_dir

BUCKET = 65536
GEO_COLS = ("country", "province", "city")


def bucketize_ranges(geo: DataFrame) -> DataFrame:
    """(lo, hi, geo cols) -> one row per /16 bucket the range touches."""
    return geo.select(
        F.explode(F.sequence(F.floor(F.col("lo") / BUCKET), F.floor(F.col("hi") / BUCKET))).alias("_bucket"),
        "lo", "hi", *GEO_COLS)


def overlapping_ranges(geo: DataFrame) -> DataFrame:
    """Pairs of ranges that overlap.  Two overlapping ranges share a bucket,
    so the check runs per bucket (partitioned window, no global sort)."""
    b = bucketize_ranges(geo)
    w = Window.partitionBy("_bucket").orderBy("lo", "hi")
    return (b.withColumn("_prev_hi", F.lag("hi").over(w))
             .withColumn("_prev_lo", F.lag("lo").over(w))
             .where(F.col("_prev_hi") >= F.col("lo"))
             .select(F.col("_prev_lo").alias("lo_a"), F.col("_prev_hi").alias("hi_a"),
                     F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
             .distinct())


def enrich_geo(df: DataFrame, geo: DataFrame, ip_col: str = "ip",
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS, validate: bool = False,
               salt: int = 8) -> DataFrame:
    """Add ``country, province, city`` to ``df`` from ``geo`` ranges.

    Existing geo columns of ``df`` are replaced.  ``validate=True`` first
    raises if two ranges overlap (an ip would otherwise match twice).

    Beyond the broadcast limit the join shuffles on the bucket, salted: each
    log row takes one of ``salt`` values from a hash of its columns (a repeated
    task sends it to the same place), each bucket row is repeated once per salt
    value, and the join key is (bucket, salt).  A /16 holding a third of all
    rows is then spread over ``salt`` partitions instead of landing in one.
    The salt only steers placement: every salt copy of a bucket row is the
    same, so the result does not depend on which salt a row drew.
    """
    if validate and overlapping_ranges(geo).limit(1).count() > 0:
        raise ValueError("geo ranges overlap")
    buckets = bucketize_ranges(geo)
    buckets, small = broadcast_if_small(buckets, broadcast_rows)
    left = df.drop(*[c for c in GEO_COLS if c in df.columns])
    left = left.withColumn("_ipn", ip_to_long(F.col(ip_col))).withColumn("_ipb", F.floor(F.col("_ipn") / BUCKET))
    salted = not small and salt > 1
    if salted:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)))
        buckets = buckets.withColumn("_gsalt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    g = buckets.alias("_g")
    cond = (F.col("_ipb") == F.col("_g._bucket")) & F.col("_ipn").between(F.col("_g.lo"), F.col("_g.hi"))
    if salted:
        cond = cond & (F.col("_salt") == F.col("_g._gsalt"))
    joined = left.join(g, cond, "left")
    keep = [F.col(c) for c in left.columns if c not in ("_ipn", "_ipb", "_salt")]
    return joined.select(*keep, *[F.col("_g." + c).alias(c) for c in GEO_COLS])


def enrich_geo_sorted(df: DataFrame, geo: DataFrame, ip_col: str = "ip") -> DataFrame:
    """``enrich_geo`` without a broadcast table, buckets or salt: a sort-merge interval join.

    Range starts and addresses are put in one order by a range partitioning on the number; the last
    start at or before an address is the only range that can hold it (ranges do not overlap),
    and it is carried on by a running window.  A task whose first addresses lie before its first
    start takes over the last start of the tasks before it: one row per task.  An address
    on a third of all rows is cut into several ranges by the rows' places in the input.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    left = df.drop(*[c for c in GEO_COLS if c in df.columns])
    place = F.struct(F.col("lo").alias("lo"), F.col("hi"), *[F.col(c) for c in GEO_COLS])
    row = F.struct(*[F.col("`" + c + "`").alias(c) for c in left.columns])
    row_type, place_type = left.select(row.alias("r")).schema["r"].dataType, geo.select(place.alias("p")).schema["p"].dataType
    starts = geo.select(F.col("lo").alias("k"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("at"),
                        place.alias("place"), F.lit(None).cast(row_type).alias("row"))
    points = left.select(ip_to_long(F.col(ip_col)).alias("k"), F.lit(1).alias("kind"), F.monotonically_increasing_id().alias("at"),
                         F.lit(None).cast(place_type).alias("place"), row.alias("row"))
    order = ["k", "kind", "at"]
    # the two passes below must see one cut into ranges: cut once, in the shared folder
    runs = (starts.unionByName(points).repartitionByRange(*order).withColumn("run", F.spark_partition_id()).checkpoint(eager=True))
    ends = runs.where("kind = 0").groupBy("run").agg(F.max("place").alias("end"))
    every = runs.select("run").distinct().join(ends, "run", "left")  # one row per task of the range partitioning
    carried = every.select("run", F.last("end", ignorenulls=True).over(
        Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    within = Window.partitionBy("run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (runs.withColumn("own", F.last("place", ignorenulls=True).over(within)).where("kind = 1")
                 .join(F.broadcast(carried), "run").select("row", "k", F.coalesce("own", "carried").alias("p")))
    hit = F.col("k") <= F.col("p.hi")
    return found.select(*[F.col("row").getField(c).alias(c) for c in left.columns],
                        *[F.when(hit, F.col("p").getField(c)).alias(c) for c in GEO_COLS])
