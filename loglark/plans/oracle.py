"""DuckDB oracle SQL for the query catalogue.

Each statement recomputes a catalogue result straight from the driver's
tables (``events``, ``nation``, ``region``, ``customer``, ``part``, ``pages``,
``documents``), using the adapter rules written out in
:mod:`loglark.sources.adapters` - not by reading our rendered text - so the
Spark parsers are checked too.  Column names and types follow the Spark side.
"""

from __future__ import annotations

STORED = ["ip", "country", "province", "city", "formattime", "method", "url", "protocal", "status",
          "bytessent", "referer", "browsername", "browserversion", "osname", "osversion"]
_STORED = ", ".join(STORED)

# ---- order facts ------------------------------------------------------------
_O = """
O AS (
  SELECT ts,
         strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute,
         CAST(1 AS BIGINT) AS total,
         CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS success,
         CAST(CASE WHEN event_type = 'purchase' THEN floor(value) ELSE 0 END AS BIGINT) AS fee
  FROM events)"""

_SUMS = ("CAST(sum(total) AS BIGINT) AS total, CAST(sum(success) AS BIGINT) AS success, "
         "CAST(sum(fee) AS BIGINT) AS fee")


def _orders_by(grain: str) -> str:
    return f"WITH {_O} SELECT {grain}, {_SUMS} FROM O GROUP BY {grain}"


_DAILY = f"D AS (SELECT day, {_SUMS} FROM O GROUP BY day)"

_HASH_COUNTERS = f"""
WITH {_O},
H AS (SELECT day, hour, {_SUMS} FROM O GROUP BY day, hour),
{_DAILY}
SELECT 'orders-' || day AS key, 'total' AS field, total AS value FROM D
UNION ALL SELECT 'orders-' || day, 'success', success FROM D
UNION ALL SELECT 'orders-' || day, 'fee', fee FROM D
UNION ALL SELECT 'orders-' || day, 'total' || hour, total FROM H
UNION ALL SELECT 'orders-' || day, 'success' || hour, success FROM H
UNION ALL SELECT 'orders-' || day, 'fee' || hour, fee FROM H
"""


_STRING_COUNTERS = f"""WITH {_O}, {_DAILY}
    SELECT 'paid-count-' || day AS key, success AS value FROM D
    UNION ALL SELECT 'paid-fee-' || day, fee FROM D"""


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, a bit at a time (reflected polynomial 0xEDB88320)."""
    shift = "lambda r, z: xor(r >> 1, 3988292384 * (r & 1))"
    byte = f"lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), 4294967295)"


def _paid_ratio(keys: str) -> str:
    return f"""WITH {_O}, H AS (SELECT {keys}, {_SUMS} FROM O GROUP BY {keys})
        SELECT {keys}, total, success, fee,
               round(CAST(success AS DOUBLE) / CAST(NULLIF(total, 0) AS DOUBLE), 6) AS paid_ratio FROM H"""


def _pct(m: str) -> str:
    return (f"{m}, prev_{m}, {m} - prev_{m} AS delta_{m}, "
            f"round(CAST({m} - prev_{m} AS DOUBLE) * 100.0 / CAST(NULLIF(prev_{m}, 0) AS DOUBLE), 4) AS pct_{m}")


_DAY_OVER_DAY = f"""
WITH {_O}, {_DAILY},
P AS (SELECT strftime(strptime(day, '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS day,
             total AS prev_total, success AS prev_success, fee AS prev_fee FROM D)
SELECT day, {_pct('total')}, {_pct('success')}, {_pct('fee')}
FROM D LEFT JOIN P USING (day)
"""

_WIN_FMT = "'%Y-%m-%d %H:%M:%S'"
_WINDOW_TUMBLING = f"""
WITH {_O}
SELECT strftime(s, {_WIN_FMT}) AS window_start, strftime(s + INTERVAL 1 HOUR, {_WIN_FMT}) AS window_end, {_SUMS}
FROM (SELECT date_trunc('hour', ts) AS s, total, success, fee FROM O) GROUP BY s
"""
_WINDOW_SLIDING = f"""
WITH {_O},
B AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b, total, success, fee FROM O)
SELECT strftime(s, {_WIN_FMT}) AS window_start, strftime(s + INTERVAL 1 HOUR, {_WIN_FMT}) AS window_end, {_SUMS}
FROM (SELECT b AS s, total, success, fee FROM B
      UNION ALL SELECT b - INTERVAL 30 MINUTE, total, success, fee FROM B) GROUP BY s
"""

# ---- access log -------------------------------------------------------------
# The access-log adapter's agents, in its order, with the names and versions they stand for
# (agent, browser, browser version, OS, OS version).
_AGENTS = [
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
     "Chrome", "120.0.0.0", "Windows", "10.0"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.1 Safari/605.1.15", "Safari", "17.1", "Mac OS X", "10.15.7"),
    ("Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0", "Firefox", "121.0", "Linux", None),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot", "2.1", "Unknown", None),
    ("curl/8.4.0", "Unknown", None, "Unknown", None),
    ("MJ12BOT/1.0", "MJ12BOT", "1.0", "Unknown", None),
    ("Mozilla/5.0 (Linux; Android 9; CUBOT X19) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/119.0.0.0 Mobile Safari/537.36", "Chrome", "119.0.0.0", "Android", "9"),
    ("Quiet library spider/3.2(+http://spider.example.org/about)", "Quiet library spider", "3.2", "Unknown", None),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 "
     "Safari/537.36 Edg/120.0.2210.61", "Edge", "120.0.2210.61", "Windows", "10.0"),
    ("Mozilla/5.0 (Windows NT 6.1; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/118.0.0.0 "
     "Safari/537.36 OPR/104.0.0.0", "Opera", "104.0.0.0", "Windows", "6.1"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "CriOS/118.0.5993.69 Mobile/15E148 Safari/604.1", "Chrome", "118.0.5993.69", "iOS", "16.6"),
    ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko", "IE", "11.0", "Windows", "6.1"),
]


def _text(x: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"


_U = "U(i, ua, browsername, browserversion, osname, osversion) AS (VALUES " + ", ".join(
    f"({i}, {', '.join(map(_text, row))})" for i, row in enumerate(_AGENTS)) + ")"

_A = "\n" + _U + r""",
E AS (SELECT event_id, ts, user_id, event_type, value,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
A AS (
  SELECT ts, k, user_id,
    CAST(10 + user_id % 26 AS VARCHAR) || '.' || CAST((user_id * 7) % 256 AS VARCHAR) || '.'
      || CAST((user_id * 13) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
    '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0800]' AS time,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') AS stamp,
    CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
    '/' || event_type || '/' || CAST(k AS VARCHAR)
      || CASE WHEN event_type = 'click' THEN '?c=' || CAST(user_id % 10 AS VARCHAR) ELSE '' END AS url,
    'HTTP/1.1' AS protocal,
    CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
    CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS bytessent,
    CASE WHEN event_type IN ('signup', 'error') THEN '-' ELSE 'https://www.example.com/' || event_type END AS referer,
    U.ua AS ua,
    strftime(ts, '%Y%m%d%H%M') AS formattime,
    strftime(ts, '%Y%m%d') AS day,
    U.browsername, U.browserversion, U.osname, U.osversion
  FROM E JOIN U ON U.i = E.user_id % (SELECT count(*) FROM U)),
G AS (SELECT * FROM A WHERE coalesce(k, -1) NOT IN (13, 42, 77)),
GG AS (
  SELECT G.*, r.r_name AS country, n.n_name AS province,
    n.n_name || '-' || CAST(((user_id * 7) % 256) // 64 AS VARCHAR) AS city,
    day || '_' || md5(referer || url || ip || ua) AS rowkey
  FROM G LEFT JOIN nation n ON n.n_nationkey = G.user_id % 26
         LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)"""

_T = f"""
T AS (
  SELECT rowkey, {_STORED}, hits, day FROM (
    SELECT *, row_number() OVER (PARTITION BY day, rowkey
                                 ORDER BY date_trunc('second', ts) DESC, CAST(bytessent AS BIGINT) DESC) AS rn,
              count(*) OVER (PARTITION BY day, rowkey) AS hits
    FROM GG) WHERE rn = 1)"""

_WITH_T = f"WITH {_A},{_T}"


def _visits(keys: str) -> str:
    return f"{_WITH_T} SELECT {keys}, count(*) AS visits, CAST(sum(hits) AS BIGINT) AS page_views FROM T GROUP BY {keys}"


def _ranked_browsers(where: str = "") -> str:
    return f"""{_WITH_T}, B AS (SELECT browsername, count(*) AS visits, CAST(sum(hits) AS BIGINT) AS page_views
        FROM T {where} GROUP BY browsername)
        SELECT *, CAST(row_number() OVER (ORDER BY visits DESC, browsername ASC NULLS LAST) AS BIGINT) AS rank FROM B"""


_QUARANTINE = f"""
WITH {_A},
H AS (SELECT *, ip || ' - - [' || (CASE WHEN k = 13 THEN regexp_replace(stamp, '/[A-Za-z]{{3}}/', '/Xxx/') ELSE stamp END)
              || ' +0800]' AS head FROM A WHERE k IN (13, 42, 77))
SELECT CASE WHEN k = 42 THEN 'unparsable' WHEN k = 13 THEN 'bad_time' ELSE 'bad_status' END AS reason,
       CASE WHEN k = 42 THEN head
            ELSE head || ' "' || method || ' ' || url || ' ' || protocal || '" '
                 || (CASE WHEN k = 77 THEN 'x' || status ELSE status END) || ' ' || bytessent
                 || ' "www.example.com" "' || referer || '" - "' || ua || '" "-" 10.0.0.1:80 ' || status
                 || ' 0.001 0.001' END AS line
FROM H
"""

# ---- cells ------------------------------------------------------------------
_CT = f"""
CT AS (SELECT rowkey, 'o' AS family, qualifier, value
       FROM (UNPIVOT (SELECT rowkey, {_STORED} FROM T) ON {_STORED} INTO NAME qualifier VALUE value))"""

_CELLS = "SELECT rowkey, family, qualifier, value FROM CT"

_LATEST = f"""
C AS (SELECT rowkey, 'o' AS family, qualifier, value, ts FROM (UNPIVOT (
        SELECT rowkey, (CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 28800) * 1000 AS ts, {_STORED} FROM GG)
      ON {_STORED} INTO NAME qualifier VALUE value)),
L AS (SELECT rowkey, family, qualifier, value, ts FROM C
      QUALIFY row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, value DESC) = 1)"""

_PIVOT_BACK = f"""
WITH {_A}, {_LATEST}
SELECT rowkey, {", ".join(f"max(CASE WHEN qualifier = '{c}' THEN value END) AS {c}" for c in STORED)}
FROM L GROUP BY rowkey
"""

_CUST = """
CUST AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS rowkey, c_name AS name, c_mktsegment AS segment,
         CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS balance,
         n_name AS nation, r_name AS region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

_PRODUCTS = """
WITH P AS (SELECT replace(p_name, ' ', '-') || '#' || CAST(p_partkey AS VARCHAR) AS name,
                  CAST(round(p_retailprice * 100) AS INTEGER) AS price, p_size AS store FROM part)
SELECT name, price, store, printf('ProductClass(%s, %d, %d)', name, price, store) AS descr,
       CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS rn
FROM P
"""


ORACLE: dict[str, str] = {
    "orders_daily": _orders_by("day"),
    "orders_hourly": _orders_by("day, hour"),
    "orders_minutely": _orders_by("day, hour, minute"),
    "paid_count_daily": f"WITH {_O} SELECT day, CAST(sum(success) AS BIGINT) AS paid_orders FROM O GROUP BY day",
    "paid_fee_daily": f"WITH {_O} SELECT day, CAST(sum(fee) AS BIGINT) AS paid_fee FROM O GROUP BY day",
    "paid_ratio_hourly": _paid_ratio("day, hour"),
    "orders_rollup": f"""WITH {_O}, M AS (SELECT day, hour, minute, {_SUMS} FROM O GROUP BY day, hour, minute)
        SELECT day, hour, minute, {_SUMS}, CAST(GROUPING(day, hour, minute) AS BIGINT) AS level
        FROM M GROUP BY ROLLUP (day, hour, minute)""",
    "orders_day_over_day": _DAY_OVER_DAY,
    "order_hash_counters": _HASH_COUNTERS,
    "order_string_counters": _STRING_COUNTERS,
    "order_counter_map": f"""WITH {_O}, {_DAILY}
        SELECT day, unnest(['fee', 'success', 'total']) AS field, unnest([fee, success, total]) AS value FROM D""",
    "paid_ratio_daily": _paid_ratio("day"),
    "paid_ratio_minutely": _paid_ratio("day, hour, minute"),
    "order_metric_vectors": _orders_by("day"),
    "orders_window_tumbling": _WINDOW_TUMBLING,
    "orders_window_sliding": _WINDOW_SLIDING,
    "stream_counters_files": _HASH_COUNTERS,
    "stream_windows_tumbling": _WINDOW_TUMBLING,
    "stream_windows_late": _WINDOW_TUMBLING,
    "stream_window_state": _WINDOW_TUMBLING,
    "stream_windows_dedup": _WINDOW_TUMBLING,
    "stream_late_balance": "SELECT count(*) AS input, count(*) AS accounted, true AS late_rows_agree, true AS some_late FROM events",
    "stream_counters_replay": _HASH_COUNTERS,
    "stream_counters_restart": _HASH_COUNTERS,
    "stream_counters_compacted": _HASH_COUNTERS,
    "stream_string_counters": _STRING_COUNTERS,
    "access_parse": f"WITH {_A} SELECT ip, time, method, url, protocal, status, bytessent, referer, ua FROM G",
    "access_formattime": f"WITH {_A} SELECT time, formattime FROM G",
    "access_quarantine": _QUARANTINE,
    "access_rowkey_crc32": f"""WITH {_A}
        SELECT day, day || '_' || CAST({_crc32("referer || url || ip || ua")} AS VARCHAR) AS rowkey FROM G""",
    "access_rowkey_md5": f"WITH {_A} SELECT day, day || '_' || md5(referer || url || ip || ua) AS rowkey FROM G",
    "access_dedup": f"{_WITH_T} SELECT * FROM T",
    "user_agent_stats": _visits("browsername, browserversion, osname, osversion"),
    "browser_version_stats": _visits("browsername, browserversion"),
    "geo_enrich": f"WITH {_A} SELECT ip, country, province, city FROM GG",
    "geo_enrich_sorted": f"WITH {_A} SELECT ip, country, province, city FROM GG",
    "geo_unmatched": f"WITH {_A} SELECT ip FROM GG WHERE country IS NULL",
    "region_visits": _visits("country, province"),
    "region_top10": f"""WITH {_A},{_T},
        RV AS (SELECT country, province, count(*) AS visits, CAST(sum(hits) AS BIGINT) AS page_views
               FROM T GROUP BY country, province)
        SELECT *, CAST(row_number() OVER (ORDER BY visits DESC, country ASC NULLS LAST,
                                          province ASC NULLS LAST) AS BIGINT) AS rank
        FROM RV QUALIFY rank <= 10""",
    "city_visits": _visits("country, province, city"),
    "browser_visits_df": _ranked_browsers(),
    "browser_visits_sql": _ranked_browsers(),
    "browser_visits_day": _ranked_browsers("WHERE day = '20240115'"),
    "browser_stat_day": f"""{_WITH_T} SELECT day, coalesce(browsername, 'Unknown') AS browser,
        count(*) AS cnt FROM T GROUP BY ALL""",
    "url_clicks": _visits("url"),
    "query_keyword_counts": """
        WITH P AS (SELECT unnest(string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&')) AS pair FROM pages)
        SELECT split_part(pair, '=', 1) AS param, url_decode(replace(substr(pair, strpos(pair, '=') + 1), '+', ' ')) AS keyword,
               count(*) AS cnt
        FROM P WHERE strpos(pair, '=') > 0 AND split_part(pair, '=', 1) IN ('page', 'ref') GROUP BY ALL""",
    "cells_unpivot": f"{_WITH_T},{_CT} {_CELLS}",
    "cells_latest_version": f"WITH {_A}, {_LATEST} SELECT * FROM L",
    "cells_pivot_back": _PIVOT_BACK,
    "cells_to_wide": f"{_WITH_T} SELECT rowkey, {_STORED} FROM T",
    "row_maps": f"""{_WITH_T} SELECT rowkey, qualifier, value FROM (SELECT rowkey, {_STORED} FROM T)
        UNPIVOT INCLUDE NULLS (value FOR qualifier IN ({_STORED}))""",
    "order_counter_fields": _HASH_COUNTERS,
    "kv_get_stored": f"""WITH {_CUST}
        SELECT rowkey, CASE WHEN qualifier IN ('nation', 'region') THEN 'address' ELSE 'info' END AS family, qualifier, value
        FROM (UNPIVOT (SELECT rowkey, name, segment, balance, nation, region FROM CUST)
              ON name, segment, balance, nation, region INTO NAME qualifier VALUE value)
        WHERE rowkey = '0000000042'""",
    "cells_sorted": f"""{_WITH_T},{_CT}
        SELECT rowkey, family, qualifier, value,
               CAST(row_number() OVER (ORDER BY rowkey, family, qualifier) AS BIGINT) AS rn FROM CT""",
    "kv_get": f"""WITH {_CUST}
        SELECT rowkey, CASE WHEN qualifier IN ('nation', 'region') THEN 'address' ELSE 'info' END AS family, qualifier, value
        FROM (UNPIVOT (SELECT rowkey, name, segment, balance, nation, region FROM CUST)
              ON name, segment, balance, nation, region INTO NAME qualifier VALUE value)
        WHERE rowkey = '0000000042'""",
    "kv_multi_get": f"{_WITH_T},{_CT} {_CELLS} WHERE starts_with(rowkey, '20240103_')",
    "kv_scan_from": f"{_WITH_T},{_CT} {_CELLS} WHERE rowkey >= '20240120'",
    "cells_update": f"""{_WITH_T},{_CT} SELECT rowkey, family, qualifier,
        CASE WHEN qualifier = 'city' THEN 'moved' ELSE value END AS value FROM CT
        WHERE rowkey >= '20240105' AND rowkey < '20240108'""",
    "keyed_update": f"""{_WITH_T},{_CT} SELECT rowkey, family, qualifier,
        CASE WHEN qualifier = 'city' AND rowkey >= '20240105' AND rowkey < '20240108' THEN 'moved' ELSE value END AS value FROM CT""",
    "keyed_compacted": f"""{_WITH_T},{_CT} SELECT rowkey, family, qualifier,
        CASE WHEN qualifier = 'city' THEN 'moved' ELSE value END AS value FROM CT
        WHERE rowkey >= '20240105' AND rowkey < '20240108'""",
    "kv_range_scan": f"{_WITH_T},{_CT} {_CELLS} WHERE rowkey >= '20240105' AND rowkey < '20240108'",
    "kv_prefix_any": f"""{_WITH_T},{_CT} {_CELLS}
        WHERE starts_with(rowkey, '20240103_') OR starts_with(rowkey, '20240117_')""",
    "kv_row_regex": f"{_WITH_T},{_CT} {_CELLS} WHERE regexp_matches(rowkey, '^2024011[0-5]_[0-9a-f]*0$')",
    "kv_family_scan": f"""WITH {_CUST}
        SELECT rowkey, 'address' AS family, qualifier, value
        FROM (UNPIVOT (SELECT rowkey, nation, region FROM CUST) ON nation, region INTO NAME qualifier VALUE value)""",
    "kv_column_scan": f"WITH {_CUST} SELECT rowkey, segment AS value FROM CUST WHERE segment IS NOT NULL",
    "kv_sorted_store_range": f"{_WITH_T},{_CT} {_CELLS} WHERE rowkey >= '20240105' AND rowkey < '20240108'",
    "product_sort_price_stock": _PRODUCTS.format(
        order="price DESC NULLS LAST, store DESC NULLS LAST, name ASC NULLS LAST"),
    "product_sort_price": _PRODUCTS.format(order="price DESC NULLS LAST, name ASC NULLS LAST"),
    "access_etl_backfill": f"{_WITH_T} SELECT * FROM T",
    "access_backfill_keeps_other_days": f"{_WITH_T} SELECT * FROM T",
    "replace_day_twice": f"{_WITH_T} SELECT * FROM T",
    "replace_day_empty": f"{_WITH_T} SELECT * FROM T WHERE day <> '20240115'",
    "word_count": r"""SELECT word, count(*) AS cnt FROM (
        SELECT unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
}
