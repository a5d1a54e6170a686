"""Access-log parse, time format and quarantine (FIXTURES §1, §2; M4, M5)."""

from pyspark.sql import functions as F

from loglark.functions.timefmt import format_time
from loglark.sources.access_log import good_rows, parse_lines, quarantined

UA_CHROME = ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
             "Chrome/120.0.0.0 Safari/537.36")


def line(ip="1.2.3.4", time="30/Jan/2019:00:04:07 +0800", req="GET /shop/items?page=3 HTTP/1.1", status="200",
         nbytes="4711", referer="https://www.example.com/", ua=UA_CHROME, tail="192.168.7.9:8080 200 0.045 0.051"):
    return (f'{ip} - - [{time}] "{req}" {status} {nbytes} "www.example.com" "{referer}" - "{ua}" "-" {tail}')


CASES = {
    "normal": line(),
    "upstream_dashes": line(tail="- - - 0.001"),
    "bot": line(ua="Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)"),
    "unknown_agent": line(ua="curl/8.4.0"),
    "query": line(req="GET /search?q=spark%20sql&page=2 HTTP/1.1"),
    "referer_dash": line(referer="-"),
    "non_ascii_url": line(req="GET /课程/列表 HTTP/1.1"),
    "empty": "",
    "missing_bracket": '1.2.3.4 - - [30/Jan/2019:00:04:07 +0800 "GET / HTTP/1.1" 200 1 "h" "-" - "ua" "-" 1 2 3 4',
    "bad_month": line(time="30/Xxx/2019:00:00:21 +0800"),
    "bad_status": line(status="OK"),
    "one_word_request": line(req="GET"),
}
EXPECTED_REASON = {"empty": "unparsable", "missing_bracket": "unparsable", "one_word_request": "unparsable",
                   "bad_month": "bad_time", "bad_status": "bad_status"}


def test_reasons_and_fields(spark):
    df = spark.createDataFrame([(k, v) for k, v in CASES.items()], "case string, value string")
    p = parse_lines(df, keep_line=True).join(df.withColumnRenamed("value", "line"), "line")
    got = {r["case"]: r for r in p.collect()}
    for case in CASES:
        assert got[case]["_reason"] == EXPECTED_REASON.get(case), case
    n = got["normal"]
    assert (n["ip"], n["method"], n["url"], n["protocal"], n["status"], n["bytessent"]) == (
        "1.2.3.4", "GET", "/shop/items?page=3", "HTTP/1.1", "200", "4711")
    assert n["time"] == "[30/Jan/2019:00:04:07 +0800]"
    assert n["referer"] == "https://www.example.com/" and n["ua"] == UA_CHROME
    assert n["formattime"] == "201901300004"
    assert got["query"]["url"] == "/search?q=spark%20sql&page=2"
    assert got["referer_dash"]["referer"] == "-"
    assert got["non_ascii_url"]["url"] == "/课程/列表"
    assert got["upstream_dashes"]["_reason"] is None


def test_good_plus_quarantine_is_input(spark):
    data = list(CASES.values()) + [CASES["normal"]]  # the same line twice
    df = spark.createDataFrame([(v,) for v in data], "value string")
    p = parse_lines(df, keep_line=True)
    assert good_rows(p).count() + quarantined(p).count() == len(data)
    assert good_rows(p).where(F.col("line") == CASES["normal"]).count() == 2


def test_formattime_zones(spark):
    df = spark.createDataFrame([("[30/Jan/2019:00:04:07 +0800]",), ("[32/Xxx/2019]",), (None,)], "t string")
    out = df.select(format_time(F.col("t"), "+08:00").alias("cn"), format_time(F.col("t"), "UTC").alias("utc"),
                    format_time(F.col("t"), "Asia/Shanghai").alias("named")).collect()
    assert (out[0]["cn"], out[0]["utc"], out[0]["named"]) == ("201901300004", "201901291604", "201901300004")
    assert out[1]["cn"] is None and out[2]["cn"] is None


def test_formattime_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("[30/Jan/2019:00:04:07 +0800]",)], "t string")
        assert df.select(format_time(F.col("t")).alias("f")).first()["f"] == "201901300004"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
