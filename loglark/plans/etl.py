"""Access-log ETL as one Catalyst plan.

read.text -> parse (P1) -> agent rules (P5) -> time (P2) -> row key (P6) ->
latest row per key (W1) -> geo range join (J1) -> replace the day (K1/K2).

The job shuffles for the dedup on (day, row key), which runs partial
aggregation first, and a backfill once more to give each day few files.  What follows from other columns (geo
from ip, ``formattime`` from the instant, the key's text from its bytes) is added
after the last shuffle.  Quarantined lines are written next to the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.functions.rowkey import access_digest, access_rowkey, digest_rowkey
from loglark.functions.timefmt import DEFAULT_ZONE, format_instant
from loglark.functions.useragent import with_agent_columns
from loglark.operators.dedup import latest_per_key
from loglark.operators.geo import bucketize_ranges, enrich_geo, overlapping_ranges
from loglark.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from loglark.schemas import STORED_FIELDS
from loglark.session import new_scratch, shuffles_freed
from loglark.sinks.tables import replace_day, replace_days, table_exists
from loglark.sources.access_log import good_rows, parse_lines, read_access_log

#: Most rows of a staged file.  Parsed log rows are packed so well that a scan split of 128 MB would hold tens of millions of
#: them, and the dedup sorts a split's rows; Spark adds an opening cost of 4 MB to every file, so a split takes about 30 of them.
STAGED_FILE_ROWS = 10_000

#: The stored columns that are neither derived after the dedup nor its order: what the dedup shuffles besides its keys.
CARRIED_FIELDS = [c for c in STORED_FIELDS if c not in ("country", "province", "city", "formattime")]


def clean_access(parsed: DataFrame, geo: DataFrame, day: str | None = None, key_algo: str = "crc32",
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Good parsed rows -> enriched rows with ``day`` and ``rowkey``.

    ``day`` is the job's day (M6) when given, else each record's own day
    (first 8 characters of ``formattime``).
    """
    df = good_rows(parsed) if "_reason" in parsed.columns else parsed
    df = enrich_geo(df, geo, broadcast_rows=broadcast_rows)
    df = with_agent_columns(df, "ua")
    day_col = F.lit(day) if day is not None else F.substring(F.col("formattime"), 1, 8)
    df = df.withColumn("day", day_col)
    return df.withColumn("rowkey", access_rowkey(F.col("day"), key_algo))


def stored_rows(clean: DataFrame) -> DataFrame:
    """One stored row per (day, rowkey), latest time first, with ``hits``."""
    slim = clean.select("day", "rowkey", "time_ts", F.col("bytessent").try_cast("bigint").alias("_bytes"),
                        *STORED_FIELDS)
    latest = latest_per_key(slim, ["day", "rowkey"], ["time_ts", "_bytes"])
    return latest.select("rowkey", *STORED_FIELDS, "hits", "day")


def access_table(lines: DataFrame, geo: DataFrame, day: str | None = None, key_algo: str = "crc32",
                 zone: str = DEFAULT_ZONE, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Raw lines -> the stored day table rows (not yet written)."""
    parsed = parse_lines(lines, zone=zone)
    return stored_rows(clean_access(parsed, geo, day, key_algo, broadcast_rows))


def latest_rows(parsed: DataFrame, day: str | None = None, key_algo: str = "crc32") -> DataFrame:
    """W1 on good parsed rows, before the columns that ``full_rows`` derives: one row per (day, row key).

    Ties go by the same columns in the same order as in ``stored_rows``: the geo columns follow from ``ip``,
    which stands before them there, and ``formattime`` from ``time_ts``.
    """
    df = with_agent_columns(parsed, "ua")
    day_col = F.lit(day) if day is not None else F.substring(F.col("formattime"), 1, 8)
    slim = df.select(day_col.alias("day"), access_digest(key_algo).alias("_digest"), "time_ts",
                     F.col("bytessent").try_cast("bigint").alias("_bytes"), *CARRIED_FIELDS)
    return latest_per_key(slim, ["day", "_digest"], ["time_ts", "_bytes"])


def full_rows(latest: DataFrame, geo: DataFrame, key_algo: str = "crc32", zone: str = DEFAULT_ZONE,
              broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``latest_rows`` -> the stored day table rows.  ``geo`` ranges must not overlap."""
    df = enrich_geo(latest, geo, broadcast_rows=broadcast_rows)
    df = df.withColumn("formattime", format_instant(F.col("time_ts"), zone))
    return df.select(digest_rowkey(F.col("day"), F.col("_digest"), key_algo).alias("rowkey"), *STORED_FIELDS, "hits", "day")


def staged_lines(lines: DataFrame, path: str, zone: str = DEFAULT_ZONE) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their line) after one pass over the raw text:
    the parse is written once to ``path``, and both outputs read their rows and columns of it.
    Rows are written as they come (one folder per outcome would make each task sort its rows first).
    A file holds at most ``STAGED_FILE_ROWS`` rows, which bounds what a task that reads it has to sort."""
    spark = lines.sparkSession
    parsed = parse_lines(lines, zone=zone, keep_line=True)
    bad = F.col("_reason").isNotNull()
    staged = parsed.withColumn("line", F.when(bad, F.col("line")))
    staged.write.option("maxRecordsPerFile", STAGED_FILE_ROWS).parquet(path)
    back = spark.read.schema(staged.schema).parquet(path)
    return back.where(~bad).drop("line", "_reason"), back.where(bad)


def run_access_etl(spark: SparkSession, input_path: str | list[str], table_path: str, day: str | None,
                   geo: DataFrame, key_algo: str = "crc32", zone: str = DEFAULT_ZONE,
                   days: Iterable[str] | None = None) -> None:
    """The batch job.

    With ``day`` (the job argument, M6): that day's files become
    ``<table>/day=<day>``, replaced as a whole, and quarantined lines go to
    ``<table>_quarantine/day=<day>``.

    A backfill (``day=None``) gives every record its own day and replaces only
    the ``days`` it lists.  Records of other days (log files roll over at midnight, so
    a day's files hold stragglers) go to ``<table>_other_days/run=<first>-<last>-<digest>``,
    named after its rows: a rerun finds its own folder, two backfills of the same days keep both.  No stored day changes.  Bad lines go to their own day's quarantine if the day
    is listed, else to ``day=unlisted-<first>-<last>``.  Without ``days`` the backfill is
    a first load of all days present and refuses a table that exists.

    The raw text is read and parsed once, into the scratch folder; that copy is deleted when all is written.
    """
    if overlapping_ranges(geo).limit(1).count() > 0:
        raise ValueError("geo ranges overlap")
    if day is None and days is None and table_exists(spark, table_path):
        raise ValueError("the table exists: list the days that the backfill replaces")
    staged = new_scratch(spark, "access-staged")
    try:
        with shuffles_freed(spark):
            good, bad = staged_lines(read_access_log(spark, input_path), staged, zone)
            _write_outputs(good, bad, table_path, day, geo, key_algo, days, zone)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(staged)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _append_once(rows: DataFrame, root: str, name: str) -> None:
    """Add ``rows`` to the folder as ``run=<name>-<digest of the rows>``; rows that are there already are not added again.
    Readers do not see the copy that is being written."""
    spark = rows.sparkSession
    writing = f"{root}/_writing-{uuid.uuid4().hex}"
    rows.write.parquet(writing)
    back = spark.read.schema(rows.schema).parquet(writing)
    n, mark = back.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*back.columns)), F.lit(0))).first()
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    final = path(f"{root}/run={name}-{n}-{mark & (1 << 64) - 1:016x}")
    if fs.exists(final):
        fs.delete(path(writing), True)
    elif not fs.rename(path(writing), final):
        raise OSError(f"cannot name {final}")


def _write_outputs(good: DataFrame, bad: DataFrame, table_path: str, day: str | None, geo: DataFrame, key_algo: str,
                   days: Iterable[str] | None, zone: str = DEFAULT_ZONE) -> None:
    latest = latest_rows(good, day, key_algo)
    # a broadcast geo table is joined after the rows were dealt by day; a larger one shuffles the rows itself, so it is joined before
    late_geo = broadcast_if_small(bucketize_ranges(geo))[1]

    def dealt(rows: DataFrame, *by: str) -> DataFrame:
        if late_geo:
            return full_rows(rows.hint("rebalance", *by), geo, key_algo, zone)
        return full_rows(rows, geo, key_algo, zone).hint("rebalance", *by)

    # bad lines are few and spread over every input split: rebalance them into
    # advisory-sized files instead of one small file per split
    lines = bad.select(F.col("_reason").alias("reason"), "line", "formattime").hint("rebalance")
    root = table_path.rstrip("/")
    if day is not None:
        replace_day(full_rows(latest, geo, key_algo, zone).drop("day"), root, day)
        replace_day(lines.drop("formattime"), root + "_quarantine", day)
        return
    own_day = F.substring(F.col("formattime"), 1, 8)
    if days is None:
        replace_days(dealt(latest, "day"), root, rebalance=False)
        bad_day, bad_days, run = F.coalesce(own_day, F.lit("unknown")), None, None
    else:
        listed = sorted(set(days))
        run = f"{listed[0]}-{listed[-1]}"
        # the day is a grouping key of the dedup, so both filters go below it: no row is deduplicated twice
        replace_days(dealt(latest.where(F.col("day").isin(listed)), "day"), root, listed, rebalance=False)
        other = dealt(latest.where(~F.col("day").isin(listed)))
        _append_once(other, root + "_other_days", run)
        bad_day = F.when(own_day.isin(listed), own_day).otherwise(F.lit(f"unlisted-{run}"))
        bad_days = [*listed, f"unlisted-{run}"]
    replace_days(lines.withColumn("day", bad_day).drop("formattime"), root + "_quarantine", bad_days)
