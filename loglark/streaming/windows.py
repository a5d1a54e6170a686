"""Event-time windows over the order stream.

Paid orders and amount per tumbling or sliding window with a watermark.
Rows later than the watermark are dropped by Spark's own window state
(``start_windowed_orders``).  ``start_order_windows`` drops none: each micro-batch is reduced
to per-window deltas by native aggregation, a late order still adds to its own window, and
it is also written to a late output with its fields; on time + late + bad = input.
Dedup by ``orderid`` is offered but off by default, as the source system did not dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loglark.functions.timefmt import ntz_as_utc_instant, order_event_time, wall_clock
from loglark.operators.dedup import latest_per_key
from loglark.operators.order_metrics import windowed_sums
from loglark.sources.orders import order_facts, parse_order_json, quarantined_orders

WINDOW_FORMAT = "yyyy-MM-dd HH:mm:ss"
WINDOW_UPDATE = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("total", T.LongType()),
    T.StructField("success", T.LongType()),
    T.StructField("fee", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def order_events_with_time(records: DataFrame) -> DataFrame:
    facts = order_facts(parse_order_json(records))
    # watermarks need an instant; the wall clock is read as UTC
    return facts.withColumn("event_time", ntz_as_utc_instant(order_event_time(F.col("time"))))


def windowed_orders(records: DataFrame, size: str, slide: str | None = None, watermark: str = "10 minutes",
                    dedup_orders: bool = False) -> DataFrame:
    ev = order_events_with_time(records).withWatermark("event_time", watermark)
    if dedup_orders:
        ev = ev.dropDuplicatesWithinWatermark(["orderid"])
    win = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    return (ev.groupBy(win.alias("w"))
              .agg(F.sum("total").cast("bigint").alias("total"),
                   F.sum("success").cast("bigint").alias("success"),
                   F.sum("fee").cast("bigint").alias("fee"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "total", "success", "fee"))


def _utc_text(ts) -> F.Column:
    return F.date_format(wall_clock(ts, "UTC"), WINDOW_FORMAT)


class WindowUpdateSink:
    """``foreachBatch`` for update-mode windows: the windows a batch changed
    go to ``<out>/batch_id=<id>`` (overwrite, so a retried batch is idempotent)."""

    def __init__(self, out_path: str):
        self.out_path = out_path.rstrip("/")

    def __call__(self, updates: DataFrame, batch_id: int) -> None:
        (updates.select(_utc_text(F.col("window_start")).alias("window_start"),
                        _utc_text(F.col("window_end")).alias("window_end"), "total", "success", "fee")
                .write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}"))


def start_windowed_orders(records: DataFrame, out_path: str, checkpoint: str, size: str,
                          slide: str | None = None, watermark: str = "10 minutes",
                          available_now: bool = False, processing_time: str = "5 seconds",
                          state_partitions: int | None = None, dedup_orders: bool = False) -> StreamingQuery:
    """X7 as a running query: update mode, each batch's changed windows stored
    under its batch id.  Window state is one row per open window, so the
    watermark can be as wide as the input's disorder at little cost.

    ``state_partitions`` sizes the state store for this query only: the
    state is per window, not per order, and only per-window partial
    aggregates reach it, so it needs few partitions whatever the volume.
    The query copies the session conf when it starts and keeps the count in
    its checkpoint, so the setting is applied around ``start()`` only.

    ``dedup_orders`` counts an order id once; its state holds each id until the
    watermark has passed the order by its width, so it is bounded by the ids of that time.
    """
    w = (windowed_orders(records, size, slide, watermark, dedup_orders).writeStream.outputMode("update")
         .foreachBatch(WindowUpdateSink(out_path)).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if state_partitions is None:
        return w.start()
    conf = records.sparkSession.conf
    old = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return w.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", old)


WINDOW_DELTA = T.StructType([*WINDOW_UPDATE.fields[:-1], T.StructField("late", T.LongType())])
_HIGHEST = T.StructType([T.StructField("highest", T.TimestampType())])


class OrderWindowSink:
    """``foreachBatch``: one parse of a batch -> window deltas, late orders, bad records.

    An order is late if its time is before the highest time of all earlier batches less
    ``watermark``.  That highest time is written with each batch, so a batch that is
    tried again, after a failure or from the checkpoint, finds the same orders late and overwrites what it wrote.
    """

    def __init__(self, out_path: str, late_path: str, quarantine_path: str, size: str, slide: str | None, watermark: str):
        self.out_path, self.late_path = out_path.rstrip("/"), late_path.rstrip("/")
        self.quarantine_path = quarantine_path.rstrip("/")
        self.size, self.slide, self.watermark = size, slide, watermark

    def _highest(self, spark: SparkSession, batch_id: int):
        """The highest time of the batches before ``batch_id`` (one stored row), None for the first."""
        if batch_id == 0:
            return None
        return spark.read.schema(_HIGHEST).parquet(f"{self.out_path}_highest/batch_id={batch_id - 1}").first()["highest"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = parse_order_json(batch).persist()
        try:
            before = self._highest(spark, batch_id)
            facts = order_facts(parsed).withColumn("event_time", ntz_as_utc_instant(order_event_time(F.col("time"))))
            highest = F.lit(before).cast("timestamp")
            late = F.coalesce(F.col("event_time") < highest - F.expr(f"INTERVAL {self.watermark}"), F.lit(False))
            facts = facts.withColumn("_late", late)
            counted = facts.withColumn("_late", F.col("_late").cast("bigint"))
            deltas = windowed_sums(counted, F.col("event_time"), self.size, self.slide,
                                   {"total": "total", "success": "success", "fee": "fee", "late": "_late"})
            (deltas.select(_utc_text(F.col("w.start")).alias("window_start"), _utc_text(F.col("w.end")).alias("window_end"),
                           "total", "success", "fee", "late")
                   .write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}"))
            (facts.where("_late").drop("_late", "event_time").hint("rebalance")
                  .write.mode("overwrite").parquet(f"{self.late_path}/batch_id={batch_id}"))
            (quarantined_orders(parsed).hint("rebalance")
                  .write.mode("overwrite").parquet(f"{self.quarantine_path}/batch_id={batch_id}"))
            (facts.agg(F.greatest(F.max("event_time"), highest).alias("highest")).write.mode("overwrite")
                .parquet(f"{self.out_path}_highest/batch_id={batch_id}"))
            self._drop(spark, f"{self.out_path}_highest/batch_id={batch_id - 2}")  # a retry needs the one before only
        finally:
            parsed.unpersist()

    @staticmethod
    def _drop(spark: SparkSession, name: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def start_order_windows(records: DataFrame, out_path: str, late_path: str, quarantine_path: str, checkpoint: str,
                        size: str, slide: str | None = None, watermark: str = "10 minutes",
                        available_now: bool = False, processing_time: str = "5 seconds") -> StreamingQuery:
    """X7 without loss: window deltas, late orders and bad records of every micro-batch."""
    w = (records.writeStream.foreachBatch(OrderWindowSink(out_path, late_path, quarantine_path, size, slide, watermark))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def window_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """Every window's totals so far, and how many of its orders were late."""
    deltas = spark.read.schema(WINDOW_DELTA).parquet(out_path)
    return deltas.groupBy("window_start", "window_end").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("total", "success", "fee", "late")])


class OrderQuarantineSink:
    """``foreachBatch``: bad records, with their text, to ``<out>/batch_id=<id>``."""

    def __init__(self, out_path: str):
        self.out_path = out_path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (quarantined_orders(parse_order_json(batch)).hint("rebalance")
            .write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}"))


def start_order_quarantine(records: DataFrame, out_path: str, checkpoint: str, available_now: bool = False,
                           processing_time: str = "5 seconds") -> StreamingQuery:
    """The records that the window query leaves out, as a stream of their own."""
    w = records.writeStream.foreachBatch(OrderQuarantineSink(out_path)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def window_view(spark: SparkSession, out_path: str) -> DataFrame:
    """Current value of every window: its update from the latest batch."""
    ups = spark.read.schema(WINDOW_UPDATE).parquet(out_path)
    latest = latest_per_key(ups, ["window_start", "window_end"], ["batch_id"], hits_col=None)
    return latest.drop("batch_id")
