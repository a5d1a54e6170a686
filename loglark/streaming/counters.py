"""Exactly-once running order counters.

Each micro-batch's counter *deltas* (at minute grain) are written to their
own directory ``<deltas>/batch_id=<id>`` with overwrite.  A batch that is
retried after a failure, or replayed from the checkpoint, rewrites the same
directory, so it cannot count twice.  The running counters are a read view:
the sum of all deltas, rolled up to the day and hour keys of D13/D14.

Deltas are folded by ``compact_deltas`` into ``<deltas>_compacted/upto=<id>``: the totals
of all batches 0 to id, without a gap.  A batch that has not ended, or that is not there yet, ends the
fold, so a batch that comes later is above it and counts.  ``drop_folded`` then deletes
what no reader needs any more, so the number of folders stays bounded however long the stream runs.

A new checkpoint restarts batch ids at 0, so it needs a new delta directory
(or a full replay of the same input, which rewrites every batch id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loglark.operators.order_metrics import hash_counters, metrics_by, string_counters
from loglark.schemas import ORDER_DELTA
from loglark.sources.orders import order_facts, parse_order_json, quarantined_orders

DELTA_WITH_BATCH = T.StructType(ORDER_DELTA.fields + [T.StructField("batch_id", T.LongType())])


class OrderCounterSink:
    """``foreachBatch`` function: parse once, write deltas and quarantine."""

    def __init__(self, delta_path: str, quarantine_path: str | None = None, compact_every: int | None = None):
        self.delta_path = delta_path.rstrip("/")
        self.quarantine_path = quarantine_path.rstrip("/") if quarantine_path else None
        self.compact_every = compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        parsed = parse_order_json(batch)
        if self.quarantine_path:
            parsed = parsed.persist()  # X6: one parse feeds two outputs
        try:
            deltas = metrics_by(order_facts(parsed), "day", "hour", "minute")
            # one row per minute the batch spans; the aggregate keeps its tasks
            deltas.write.mode("overwrite").parquet(f"{self.delta_path}/batch_id={batch_id}")
            if self.quarantine_path:
                (quarantined_orders(parsed).hint("rebalance").write.mode("overwrite")
                    .parquet(f"{self.quarantine_path}/batch_id={batch_id}"))
        finally:
            if self.quarantine_path:
                parsed.unpersist()
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # this batch may still be retried: fold only those before it
            compact_deltas(batch.sparkSession, self.delta_path, batch_id - 1)
            drop_folded(batch.sparkSession, self.delta_path)


def start_order_counters(records: DataFrame, delta_path: str, checkpoint: str,
                         quarantine_path: str | None = None, processing_time: str | None = "5 seconds",
                         available_now: bool = False, compact_every: int | None = None) -> StreamingQuery:
    """Run the counter sink on every micro-batch of ``records``; with ``compact_every`` the
    deltas are folded, and the folded ones dropped, every so many batches."""
    w = (records.writeStream.foreachBatch(OrderCounterSink(delta_path, quarantine_path, compact_every))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_deltas(spark: SparkSession, delta_path: str) -> DataFrame:
    return spark.read.schema(DELTA_WITH_BATCH).parquet(delta_path)


def compaction_path(delta_path: str) -> str:
    """Where the folded deltas of a delta folder are kept."""
    return delta_path.rstrip("/") + "_compacted"


def minute_totals(spark: SparkSession, delta_path: str) -> DataFrame:
    """Running totals at minute grain: the latest compaction plus all later deltas."""
    return minute_totals_compacted(spark, delta_path, compaction_path(delta_path))


def hash_counter_view(spark: SparkSession, delta_path: str, prefix: str = "orders-") -> DataFrame:
    """K6 read view: ``(key, field, value)`` like ``hincrBy`` would have left."""
    return hash_counters(minute_totals(spark, delta_path), prefix)


def string_counter_view(spark: SparkSession, delta_path: str, count_prefix: str = "paid-count-",
                        fee_prefix: str = "paid-fee-") -> DataFrame:
    """K5 read view: ``(key, value)`` like ``incrBy`` would have left."""
    daily = metrics_by(minute_totals(spark, delta_path), "day")
    return string_counters(daily, count_prefix, fee_prefix)


def committed(spark: SparkSession, root: str, key: str) -> list[int]:
    """The numbers n of the folders ``<root>/<key>=<n>`` whose write has ended
    (they hold ``_SUCCESS``).  A folder that cannot be listed raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(path)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n.split("=", 1)[1]) for p, n in names if n.startswith(key + "=") and fs.exists(done(p, "_SUCCESS")))


def latest_compaction(spark: SparkSession, compact_path: str) -> int | None:
    """Highest batch id folded so far: the last ``upto=<id>`` whose write has
    ended, None if there is none.  Its content is not read here, so a damaged
    compaction fails the read that needs it instead of counting as absent."""
    return max(committed(spark, compact_path, "upto"), default=None)


def compact_deltas(spark: SparkSession, delta_path: str, upto_batch: int | None = None,
                   compact_path: str | None = None) -> int | None:
    """Fold finished batches into ``<compact_path>/upto=<id>``; returns the last batch folded so far.

    Batches are folded in order from the one after the previous fold, up to ``upto_batch`` and to the first that
    is missing or has not ended.  Incremental: the previous compaction plus the deltas after it.
    """
    compact_path = compact_path or compaction_path(delta_path)
    prev = latest_compaction(spark, compact_path)
    there, last = set(committed(spark, delta_path, "batch_id")), -1 if prev is None else prev
    first = last + 1
    while last + 1 in there and (upto_batch is None or last < upto_batch):
        last += 1
    if last < first:
        return prev
    new = read_deltas(spark, delta_path).where(F.col("batch_id").between(first, last)).drop("batch_id")
    if prev is not None:
        new = new.unionByName(spark.read.schema(ORDER_DELTA).parquet(f"{compact_path.rstrip('/')}/upto={prev}"))
    (metrics_by(new, "day", "hour", "minute")
        .write.mode("overwrite").parquet(f"{compact_path.rstrip('/')}/upto={last}"))
    return last


def drop_folded(spark: SparkSession, delta_path: str, compact_path: str | None = None) -> list[str]:
    """Delete the folders that the last two compactions make needless: older compactions, and the deltas in the
    last but one (a reader that began before the last one still finds all it needs).  Returns their names."""
    compact_path = compact_path or compaction_path(delta_path)
    folds = committed(spark, compact_path, "upto")
    if len(folds) < 2:
        return []
    gone = [f"{compact_path.rstrip('/')}/upto={n}" for n in folds[:-2]]
    gone += [f"{delta_path.rstrip('/')}/batch_id={n}" for n in committed(spark, delta_path, "batch_id") if n <= folds[-2]]
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(delta_path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in gone:
        fs.delete(path(name), True)
    return gone


def minute_totals_compacted(spark: SparkSession, delta_path: str, compact_path: str,
                            upto_batch: int | None = None) -> DataFrame:
    """Running minute totals = latest compaction + deltas of later batches."""
    upto = latest_compaction(spark, compact_path) if upto_batch is None else upto_batch
    if upto is None:
        return metrics_by(read_deltas(spark, delta_path), "day", "hour", "minute")
    base = spark.read.schema(ORDER_DELTA).parquet(f"{compact_path.rstrip('/')}/upto={upto}")
    rest = read_deltas(spark, delta_path).where(F.col("batch_id") > upto).drop("batch_id")
    return metrics_by(base.unionByName(rest), "day", "hour", "minute")
