"""Access-log source (S1, U2) and line parser.

Line shape (nginx combined log with extra fields)::

    <ip> - - [dd/MMM/yyyy:HH:mm:ss Z] "<method> <url> <protocol>" <status> <bytes>
    "<host>" "<referer>" - "<ua>" "<xff>" <upstream> <upstream status> <up time> <req time>

One regular expression validates the line; the fields are then cut out with
``split`` on the quote and space characters (cheaper than one regex match per
field).  Rows that fail go to quarantine with a reason instead of failing the
job; good rows plus quarantined rows always add up to the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.functions.timefmt import DEFAULT_ZONE, format_instant, parse_log_time

LINE_PATTERN = (
    r'^\S+ \S+ \S+ \[[^\]]*\] "\S+ \S+ \S+" \S+ \S+ "[^"]*" "[^"]*" \S+ "[^"]*" "[^"]*"( .*)?$'
)

REASON_UNPARSABLE = "unparsable"
REASON_BAD_TIME = "bad_time"
REASON_BAD_STATUS = "bad_status"


def read_access_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines of one or more day folders / globs as ``value string``."""
    return spark.read.text(path)


def _field(arr: Column, i: int) -> Column:
    return F.get(arr, i)


def parse_lines(lines: DataFrame, value_col: str = "value", zone: str = DEFAULT_ZONE,
                keep_line: bool = False) -> DataFrame:
    """Lines -> raw fields + ``time_ts`` (instant) + ``formattime`` + ``_reason``.

    ``_reason`` is NULL for a good row.  Geo and agent columns are added by
    later operators.
    """
    v = F.col(value_col)
    # Stage 1: validate once and cut the line at its quotes once; the pieces
    # are columns so the field extractions below do not repeat the split.
    staged = lines.select(
        *([v.alias("line")] if keep_line else []),
        v.rlike(LINE_PATTERN).alias("_ok"),
        F.split(v, '"', -1).alias("_q"))
    q = F.col("_q")
    ok = F.col("_ok")
    head = _field(q, 0)
    head_words = F.split(F.trim(head), " ", -1)
    req = F.split(_field(q, 1), " ", -1)
    tail = F.split(F.trim(_field(q, 2)), " ", -1)
    time_text = F.concat(F.lit("["), F.regexp_extract(head, r"\[(.*)\]", 1), F.lit("]"))

    out = staged.select(
        *([F.col("line")] if keep_line else []),
        F.when(ok, _field(head_words, 0)).alias("ip"),
        F.when(ok, time_text).alias("time"),
        F.when(ok, _field(req, 0)).alias("method"),
        F.when(ok, _field(req, 1)).alias("url"),
        F.when(ok, _field(req, 2)).alias("protocal"),
        F.when(ok, _field(tail, 0)).alias("status"),
        F.when(ok, _field(tail, 1)).alias("bytessent"),
        F.when(ok, _field(q, 5)).alias("referer"),
        F.when(ok, _field(q, 7)).alias("ua"),
        ok.alias("_ok"),
    )
    out = out.withColumn("time_ts", parse_log_time(F.col("time")))
    out = out.withColumn("formattime", format_instant(F.col("time_ts"), zone))
    reason = (
        F.when(~F.col("_ok"), F.lit(REASON_UNPARSABLE))
        .when(F.col("time_ts").isNull(), F.lit(REASON_BAD_TIME))
        .when(~F.col("status").rlike("^[0-9]{3}$"), F.lit(REASON_BAD_STATUS))
    )
    out = out.withColumn("_reason", reason).drop("_ok")
    # Emit each parsed row through a one-row generator (a flatMap).  Catalyst
    # pushes a filter on ``_reason`` below plain projections by inlining the
    # parse into it - the time parse would run twice per line - but it does
    # not push a predicate on generated columns below the Generate.
    return out.select(F.inline(F.array(F.struct(*[F.col(c) for c in out.columns]))))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_reason").isNull()).drop("_reason")


def quarantined(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    cols = [F.col("_reason").alias("reason")]
    if line_col in parsed.columns:
        cols.append(F.col(line_col))
    return parsed.where(F.col("_reason").isNotNull()).select(*cols)
