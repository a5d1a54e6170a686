"""Command-line jobs (the driver programs of the source system, as spark-submit
entry points):

    python -m loglark.jobs etl --day 20190130 --input '<logs>/20190130/*' --table <access> --geo <ranges>
    python -m loglark.jobs etl --days 20190129 20190130 --input '<logs>/*/*' --table <access> --geo <ranges>   (backfill)
    python -m loglark.jobs etl --first-load --input '<logs>/*/*' --table <access> --geo <ranges>
    python -m loglark.jobs analysis --day 20190130 --table <access> --out <browser_stat>
    python -m loglark.jobs counters --files <dir> | --kafka host:port --topic t
                                    --deltas <dir> --checkpoint <dir> --quarantine <dir>
    python -m loglark.jobs windows --files <dir> --size '1 hour' --out <dir> --checkpoint <dir>
                                    --quarantine <dir> [--late <dir>] [--dedup]
    python -m loglark.jobs compact --deltas <dir> [--upto <batch id>] [--drop-folded]
    python -m loglark.jobs products --input <text> --out <dir>

Paths are any URI the cluster can read (HDFS, object store).  The geo table
is Parquet with ``lo, hi, country, province, city``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loglark.functions.timefmt import DEFAULT_ZONE
from loglark.operators import traffic
from loglark.operators.ranking import parse_products, ranked_products
from loglark.plans.etl import run_access_etl
from loglark.schemas import ACCESS_TABLE_WITH_DAY, GEO_RANGE
from loglark.session import get_session
from loglark.sinks.records import show
from loglark.sinks.tables import read_day_table, replace_day
from loglark.streaming.counters import compact_deltas, drop_folded, start_order_counters
from loglark.streaming.sources import order_stream_from_files, order_stream_from_kafka
from loglark.streaming.windows import start_order_quarantine, start_order_windows, start_windowed_orders


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loglark.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    e = sub.add_parser("etl", help="one day of access logs -> the day table (replaced)")
    which = e.add_mutually_exclusive_group(required=True)
    which.add_argument("--day", help="yyyyMMdd; all input becomes this partition")
    which.add_argument("--days", nargs="+", help="backfill: each record goes to its own day, and only these days are replaced")
    which.add_argument("--first-load", action="store_true", help="all days of the input, into a table that does not exist yet")
    e.add_argument("--input", required=True, help="glob of the log files")
    e.add_argument("--table", required=True)
    e.add_argument("--geo", required=True, help="Parquet geo ranges")
    e.add_argument("--key", default="md5", choices=["crc32", "md5"],
                   help="crc32 merges different lines of equal checksum: about 11 %% of a billion keys a day")
    e.add_argument("--zone", default=DEFAULT_ZONE)

    a = sub.add_parser("analysis", help="region and browser counts of one day; browser_stat rows")
    a.add_argument("--day", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--out", help="browser_stat table (day-partitioned Parquet); printed when absent")
    a.add_argument("--top", type=int, default=10)

    for name, helptext in (("counters", "order stream -> exactly-once counter deltas"),
                           ("windows", "order stream -> event-time window updates")):
        c = sub.add_parser(name, help=helptext)
        src = c.add_mutually_exclusive_group(required=True)
        src.add_argument("--files", help="folder of JSON-lines files")
        src.add_argument("--kafka", help="bootstrap servers")
        c.add_argument("--topic")
        c.add_argument("--checkpoint", required=True)
        c.add_argument("--quarantine", required=True, help="folder for bad records, with their text")
        c.add_argument("--max-offsets", type=int, help="records per trigger (Kafka)")
        c.add_argument("--min-partitions", type=int, help="split Kafka partitions into at least this many tasks")
        c.add_argument("--interval", default="5 seconds")
        c.add_argument("--available-now", action="store_true", help="process what exists, then stop")
        if name == "counters":
            c.add_argument("--deltas", required=True)
            c.add_argument("--compact-every", type=int, help="fold the deltas, and drop the folded ones, every so many batches")
        else:
            c.add_argument("--out", required=True)
            c.add_argument("--size", default="1 hour")
            c.add_argument("--slide")
            c.add_argument("--watermark", default="10 minutes")
            c.add_argument("--late", help="keep late orders: they add to their window and are written here")
            c.add_argument("--dedup", action="store_true", help="count an order id once within the watermark")
            c.add_argument("--state-partitions", type=int, help="state store partitions (first start only)")

    k = sub.add_parser("compact", help="fold finished counter deltas into one compaction")
    k.add_argument("--deltas", required=True)
    k.add_argument("--upto", type=int, help="last batch id to fold; all finished ones when absent")
    k.add_argument("--drop-folded", action="store_true", help="delete deltas and compactions that are no longer needed")

    r = sub.add_parser("products", help="'name price store' lines -> ranked by price, then stock")
    r.add_argument("--input", required=True)
    r.add_argument("--out")
    r.add_argument("--price-only", action="store_true")
    return p


def _stream_source(spark: SparkSession, args):
    if args.files:
        return order_stream_from_files(spark, args.files)
    return order_stream_from_kafka(spark, args.kafka, args.topic, max_offsets=args.max_offsets,
                                   min_partitions=args.min_partitions)


def _await_both(*queries) -> None:
    """Wait until all queries end; if one fails, stop the others and raise, so that none runs on unwatched."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                q.awaitTermination(1)
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or get_session(app=f"loglark-{args.job}")

    if args.job == "etl":
        geo = spark.read.schema(GEO_RANGE).parquet(args.geo)
        run_access_etl(spark, args.input, args.table, args.day, geo, args.key, args.zone, days=args.days)

    elif args.job == "analysis":
        day = read_day_table(spark, args.table, ACCESS_TABLE_WITH_DAY, [args.day])
        show(traffic.region_top(day, args.top))
        stat = traffic.browser_stat(day)
        if args.out:
            replace_day(stat.drop("day"), args.out, args.day)
        else:
            show(traffic.browser_visits(day))

    elif args.job in ("counters", "windows"):
        records = _stream_source(spark, args)
        if args.job == "counters":
            q = start_order_counters(records, args.deltas, args.checkpoint, args.quarantine,
                                     processing_time=args.interval, available_now=args.available_now,
                                     compact_every=args.compact_every)
        elif args.late:
            if args.dedup:
                raise SystemExit("--dedup keeps its ids in the window state, which --late does without")
            q = start_order_windows(records, args.out, args.late, args.quarantine, args.checkpoint, args.size, args.slide,
                                    args.watermark, available_now=args.available_now, processing_time=args.interval)
        else:
            q = start_windowed_orders(records, args.out, args.checkpoint, args.size, args.slide, args.watermark,
                                      available_now=args.available_now, processing_time=args.interval,
                                      state_partitions=args.state_partitions, dedup_orders=args.dedup)
            bad = start_order_quarantine(_stream_source(spark, args), args.quarantine, args.checkpoint.rstrip("/") + "-quarantine",
                                         available_now=args.available_now, processing_time=args.interval)
            _await_both(q, bad)
            return
        q.awaitTermination()

    elif args.job == "compact":
        compact_deltas(spark, args.deltas, args.upto)
        if args.drop_folded:
            drop_folded(spark, args.deltas)

    elif args.job == "products":
        ranked = ranked_products(parse_products(spark.read.text(args.input)),
                                 "price" if args.price_only else "price_store")
        if args.out:
            ranked.write.mode("overwrite").parquet(args.out)
        else:
            show(ranked.orderBy(F.col("rn")))


if __name__ == "__main__":
    main()
