"""Order metrics (A7-A14, A17, W3, D12-D14, X7 batch form).

Input is the output of :func:`loglark.sources.orders.order_facts`: one row per
good order with ``day, hour, minute, total(1), success(0/1), fee``.  A grain
with only unpaid orders still gets a row with 0 (conditional sums, M9).

At scale everything starts from one partial+final aggregate at minute grain;
day and hour totals, the rollup and the counters are computed from that small
result instead of re-reading the orders.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglark.functions.timefmt import order_event_time

METRICS = ("total", "success", "fee")


def _sums(prefix: str = "") -> list:
    return [F.sum(F.col(m)).cast("bigint").alias(prefix + m) for m in METRICS]


def metric_vector(facts: DataFrame) -> DataFrame:
    """The per-order metric vector ``[1, success, fee]``."""
    return facts.withColumn("metrics", F.array(*[F.col(m).cast("bigint") for m in METRICS]))


def vector_sum(df: DataFrame, col: str, size: int, *grain: str, name: str = "metrics") -> DataFrame:
    """Element-wise sum of a fixed-size numeric array per grain (one
    partial+final aggregate of ``size`` sums, not a zip in a reduce)."""
    sums = [F.sum(F.col(col).getItem(i)).cast("bigint") for i in range(size)]
    return df.groupBy(*grain).agg(F.array(*sums).alias(name))


def metrics_by(facts: DataFrame, *grain: str) -> DataFrame:
    """total / success / fee per grain (A9 day, A10 day+hour, A13 minute)."""
    return facts.groupBy(*grain).agg(*_sums())


def minute_metrics(facts: DataFrame) -> DataFrame:
    return metrics_by(facts, "day", "hour", "minute")


def paid_count(facts: DataFrame, *grain: str) -> DataFrame:
    """Paid orders per grain (0 when none paid)."""
    return facts.groupBy(*grain).agg(F.sum("success").cast("bigint").alias("paid_orders"))


def paid_fee(facts: DataFrame, *grain: str) -> DataFrame:
    """Paid amount per grain."""
    return facts.groupBy(*grain).agg(F.sum("fee").cast("bigint").alias("paid_fee"))


def with_paid_ratio(metrics: DataFrame, digits: int = 6) -> DataFrame:
    """Success / total, NULL when total is 0."""
    return metrics.withColumn(
        "paid_ratio", F.round(F.try_divide(F.col("success").cast("double"), F.col("total").cast("double")), digits))


def rollup_metrics(facts: DataFrame) -> DataFrame:
    """Day / hour / minute totals and the grand total in one result.

    ``level`` is ``grouping_id(day, hour, minute)``: 0 minute rows, 1 hour
    rows, 3 day rows, 7 the grand total.  The rollup's row expansion runs on
    the minute aggregate, not on the orders.
    """
    m = minute_metrics(facts)
    return (m.rollup("day", "hour", "minute")
             .agg(*[F.sum(c).cast("bigint").alias(c) for c in METRICS],
                  F.grouping_id("day", "hour", "minute").cast("int").alias("level")))


def rollup_three_passes(facts: DataFrame) -> DataFrame:
    """Naive form of A17 (three separate aggregations), for the benchmark."""
    d = metrics_by(facts, "day").select("day", F.lit(None).cast("string").alias("hour"),
                                        F.lit(None).cast("string").alias("minute"), *METRICS, F.lit(3).alias("level"))
    h = metrics_by(facts, "day", "hour").select("day", "hour", F.lit(None).cast("string").alias("minute"),
                                                *METRICS, F.lit(1).alias("level"))
    mi = metrics_by(facts, "day", "hour", "minute").select("day", "hour", "minute", *METRICS, F.lit(0).alias("level"))
    return d.unionByName(h).unionByName(mi)


def day_over_day(daily: DataFrame, day_fmt: str = "yyyyMMdd") -> DataFrame:
    """Each day against the calendar day before (growth, decline, percent).

    An equi join of the daily aggregate with itself shifted by one day, so no
    single-partition window is needed; a day whose previous day has no orders
    gets NULL previous values.
    """
    prev = daily.select(
        F.date_format(F.date_add(F.try_to_date(F.col("day"), day_fmt), 1), day_fmt).alias("day"),
        *[F.col(m).alias("prev_" + m) for m in METRICS])
    j = daily.join(prev, "day", "left")
    cols = [F.col("day")]
    for m in METRICS:
        cols += [F.col(m), F.col("prev_" + m), (F.col(m) - F.col("prev_" + m)).alias("delta_" + m),
                 F.round(F.try_divide((F.col(m) - F.col("prev_" + m)) * 100.0, F.col("prev_" + m).cast("double")),
                         4).alias("pct_" + m)]
    return j.select(*cols)


def hash_counters(minute: DataFrame, prefix: str = "orders-") -> DataFrame:
    """D14 long form: key ``<prefix><day>``; fields ``total, success, fee`` per
    day and ``total<HH>, success<HH>, fee<HH>`` per hour."""
    r = (minute.rollup("day", "hour")
               .agg(*[F.sum(c).cast("bigint").alias(c) for c in METRICS],
                    F.grouping_id("day", "hour").alias("_g"))
               .where(F.col("_g") < 2))
    suffix = F.when(F.col("_g") == 0, F.col("hour")).otherwise(F.lit(""))
    pairs = F.array(*[F.struct(F.concat(F.lit(m), suffix).alias("field"), F.col(m).alias("value")) for m in METRICS])
    return (r.select(F.concat(F.lit(prefix), F.col("day")).alias("key"), F.explode(pairs).alias("_p"))
             .select("key", "_p.field", "_p.value"))


def string_counters(daily: DataFrame, count_prefix: str = "paid-count-",
                    fee_prefix: str = "paid-fee-") -> DataFrame:
    """``<count_prefix><day>`` -> paid orders, ``<fee_prefix><day>`` -> paid fee."""
    pairs = F.array(
        F.struct(F.concat(F.lit(count_prefix), F.col("day")).alias("key"), F.col("success").alias("value")),
        F.struct(F.concat(F.lit(fee_prefix), F.col("day")).alias("key"), F.col("fee").alias("value")))
    return daily.select(F.explode(pairs).alias("_p")).select("_p.key", F.col("_p.value").cast("bigint").alias("value"))


def counters_as_map(counters: DataFrame) -> DataFrame:
    """D14 map view: one row per key with ``map(field -> value)``."""
    return counters.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """Seconds of an interval such as ``1 hour`` or ``2 days 30 minutes``."""
    words = text.lower().removeprefix("interval ").split()
    try:
        return sum(int(n) * _SECONDS[unit.removesuffix("s")] for n, unit in zip(words[::2], words[1::2], strict=True))
    except (KeyError, ValueError) as e:
        raise ValueError(f"not an interval of seconds to weeks: {text!r}") from e


def windowed_sums(rows: DataFrame, ts: Column, size: str, slide: str | None, sums: dict[str, str]) -> DataFrame:
    """``sums`` (result name -> column) per event-time window ``w``.

    A sliding window of 1 hour by 1 minute holds each row 60 times.  Rows are therefore summed
    per pane first (the greatest common divisor of size and slide divides both, so
    every window is made of whole panes), and only the panes are expanded to their windows.
    """
    if slide is None or slide == size:
        return rows.groupBy(F.window(ts, size).alias("w")).agg(*[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])
    pane = f"{math.gcd(interval_seconds(size), interval_seconds(slide))} seconds"
    panes = rows.groupBy(F.window(ts, pane).alias("p")).agg(*[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()])
    panes = panes.select(F.col("p.start").alias("at"), *sums)
    return panes.groupBy(F.window("at", size, slide).alias("w")).agg(*[F.sum(n).cast("bigint").alias(n) for n in sums])


def window_metrics(facts: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """X7 (batch run): total / success / fee per event-time window."""
    g = windowed_sums(facts, order_event_time(F.col("time")), size, slide, {m: m for m in METRICS})
    return g.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), *METRICS)
