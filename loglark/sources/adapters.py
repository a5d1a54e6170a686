"""Adapters from the driver's tables to the inputs of the log and order jobs.

The driver's parquet tables hold no raw access log and no order JSON, so these
functions derive them, as Spark transformations, from ``events``, ``nation``,
``region`` and ``part``.  They only use integer and string arithmetic, so an
SQL oracle can recompute every derived field straight from the source columns.

Access-log adapter (one line per event)
    ip        ``(10 + user_id % 26).(user_id*7 % 256).(user_id*13 % 256).(user_id % 256)``
    time      ``[dd/MMM/yyyy:HH:mm:ss +0800]`` of ``ts``
    method    POST for purchase, else GET
    url       ``/<event_type>/<k>``, clicks add ``?c=<user_id % 10>``
    protocol  HTTP/1.1
    status    500 for error, else 200
    bytes     ``floor(value * 100)``
    referer   ``-`` for signup and error, else ``https://www.example.com/<event_type>``
    ua        one of twelve fixed agents by ``user_id % 12``
  Dirty lines, by the ``k`` of ``props``: k = 13 has a bad month, k = 42 is cut
  after the time, k = 77 has a non-numeric status.

Order adapter (one JSON record per event)
    time=yyyyMMddHHmmss of ts, userid=user_id, courseid=k, orderid=event_id,
    fee=floor(value), flag='1' for purchase else '0'.

Geo adapter
    nation n owns first octet 10+n; its /8 is cut in four cities by the second
    octet (q = octet div 64); country = region name, province = nation name,
    city = ``<nation name>-<q>``.  First octet 35 has no owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The user agents of the access-log adapter, by user_id modulo their number.
AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "curl/8.4.0",
    "MJ12BOT/1.0",
    "Mozilla/5.0 (Linux; Android 9; CUBOT X19) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/119.0.0.0 Mobile Safari/537.36",
    "Quiet library spider/3.2(+http://spider.example.org/about)",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 "
    "Safari/537.36 Edg/120.0.2210.61",
    "Mozilla/5.0 (Windows NT 6.1; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 "
    "Safari/537.36 OPR/104.0.0.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "CriOS/118.0.5993.69 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko",
]

DIRTY_BAD_MONTH_K = 13
DIRTY_CUT_K = 42
DIRTY_BAD_STATUS_K = 77

CITY_SPLITS = 4  # cities per nation, by second octet


def event_k(events: DataFrame) -> Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("bigint")


def access_fields(events: DataFrame) -> DataFrame:
    """Per event: the fields a log line is rendered from (also used by tests)."""
    uid = F.col("user_id")
    k = event_k(events)
    et = F.col("event_type")
    ip = F.concat_ws(
        ".", (F.lit(10) + uid % 26).cast("string"), ((uid * 7) % 256).cast("string"),
        ((uid * 13) % 256).cast("string"), (uid % 256).cast("string"))
    url = F.concat(F.lit("/"), et, F.lit("/"), k.cast("string"),
                   F.when(et == "click", F.concat(F.lit("?c="), (uid % 10).cast("string"))).otherwise(F.lit("")))
    agents = F.array(*[F.lit(a) for a in AGENTS])
    return events.select(
        F.col("event_id"), F.col("ts"), k.alias("k"),
        ip.alias("ip"),
        F.when(et == "purchase", F.lit("POST")).otherwise(F.lit("GET")).alias("method"),
        url.alias("url"),
        F.lit("HTTP/1.1").alias("protocal"),
        F.when(et == "error", F.lit("500")).otherwise(F.lit("200")).alias("status"),
        F.floor(F.col("value") * 100).cast("bigint").cast("string").alias("bytessent"),
        F.when(et.isin("signup", "error"), F.lit("-"))
         .otherwise(F.concat(F.lit("https://www.example.com/"), et)).alias("referer"),
        F.element_at(agents, (uid % len(AGENTS) + 1).cast("int")).alias("ua"),
    )


def events_to_log_lines(events: DataFrame) -> DataFrame:
    """events -> ``value string`` access-log lines (dirty ones included)."""
    f = access_fields(events)
    k = F.col("k")
    stamp = F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss")
    stamp = F.when(k == DIRTY_BAD_MONTH_K, F.regexp_replace(stamp, "/[A-Za-z]{3}/", "/Xxx/")).otherwise(stamp)
    status = F.when(k == DIRTY_BAD_STATUS_K, F.concat(F.lit("x"), F.col("status"))).otherwise(F.col("status"))
    head = F.concat(F.col("ip"), F.lit(" - - ["), stamp, F.lit(" +0800]"))
    line = F.concat(
        head, F.lit(' "'), F.col("method"), F.lit(" "), F.col("url"), F.lit(" "), F.col("protocal"),
        F.lit('" '), status, F.lit(" "), F.col("bytessent"),
        F.lit(' "www.example.com" "'), F.col("referer"), F.lit('" - "'), F.col("ua"),
        F.lit('" "-" 10.0.0.1:80 '), F.col("status"), F.lit(" 0.001 0.001"))
    line = F.when(k == DIRTY_CUT_K, head).otherwise(line)
    return f.select(line.alias("value"))


def events_to_order_json(events: DataFrame) -> DataFrame:
    """events -> ``value string`` order JSON records (all fields as text)."""
    k = event_k(events)
    rec = F.struct(
        F.date_format(F.col("ts"), "yyyyMMddHHmmss").alias("time"),
        F.col("user_id").cast("string").alias("userid"),
        k.cast("string").alias("courseid"),
        F.col("event_id").cast("string").alias("orderid"),
        F.floor(F.col("value")).cast("bigint").cast("string").alias("fee"),
        F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit("0")).alias("flag"),
    )
    return events.select(F.to_json(rec).alias("value"))


def geo_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation x its four cities -> inclusive, non-overlapping IPv4 ranges."""
    q = F.explode(F.sequence(F.lit(0), F.lit(CITY_SPLITS - 1))).alias("q")
    n = nation.select("n_nationkey", "n_name", "n_regionkey", q)
    span = (256 // CITY_SPLITS) * 65536
    lo = (F.lit(10) + F.col("n_nationkey")).cast("bigint") * 16777216 + F.col("q").cast("bigint") * span
    # region is a dimension of five rows; Spark's size-based broadcast picks it.
    return n.join(region, n.n_regionkey == region.r_regionkey, "left").select(
        lo.alias("lo"), (lo + span - 1).alias("hi"),
        F.col("r_name").alias("country"), F.col("n_name").alias("province"),
        F.concat(F.col("n_name"), F.lit("-"), F.col("q").cast("string")).alias("city"))


def part_to_product_lines(part: DataFrame) -> DataFrame:
    """part -> ``name price store`` text (price in cents, store = p_size)."""
    name = F.concat(F.regexp_replace(F.col("p_name"), " ", "-"), F.lit("#"), F.col("p_partkey").cast("string"))
    price = F.round(F.col("p_retailprice") * 100).cast("int")
    return part.select(F.concat_ws(" ", name, price.cast("string"), F.col("p_size").cast("string")).alias("value"))
