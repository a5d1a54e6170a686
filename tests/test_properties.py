"""Property tests (hypothesis): round trips and brute-force equivalence.

Each example is a whole batch of rows so that one Spark job checks many cases.
"""

import datetime as dt
import zlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglark.functions.rowkey import crc32_key
from loglark.operators.dedup import latest_per_key
from loglark.operators.geo import enrich_geo
from loglark.schemas import GEO_RANGE
from loglark.sources.access_log import parse_lines

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

token = st.text(st.characters(min_codepoint=33, max_codepoint=126, exclude_characters='"'), min_size=1,
                max_size=20)
free_text = st.text(st.characters(min_codepoint=32, max_codepoint=0x2FFF, exclude_characters='"\n\r'),
                    max_size=40)
record = st.fixed_dictionaries({
    "ip": st.tuples(*[st.integers(0, 255)] * 4).map(lambda t: ".".join(map(str, t))),
    "ts": st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 12, 31)).map(lambda d: d.replace(microsecond=0)),
    "offset": st.integers(-12 * 60, 14 * 60).map(lambda m: m - m % 15),
    "method": st.sampled_from(["GET", "POST", "HEAD"]),
    "url": token.map(lambda t: "/" + t),
    "status": st.integers(100, 599).map(str),
    "bytes": st.integers(0, 10 ** 9).map(str),
    "referer": st.one_of(st.just("-"), free_text),
    "ua": free_text,
})


def render(r):
    off = r["offset"]
    sign = "+" if off >= 0 else "-"
    z = f"{sign}{abs(off) // 60:02d}{abs(off) % 60:02d}"
    t = r["ts"].strftime("%d/%b/%Y:%H:%M:%S")
    return (f'{r["ip"]} - - [{t} {z}] "{r["method"]} {r["url"]} HTTP/1.1" {r["status"]} {r["bytes"]} '
            f'"www.example.com" "{r["referer"]}" - "{r["ua"]}" "-" 10.0.0.1:80 200 0.001 0.001')


def expected_formattime(r):
    aware = r["ts"].replace(tzinfo=dt.timezone(dt.timedelta(minutes=r["offset"])))
    return aware.astimezone(dt.timezone(dt.timedelta(hours=8))).strftime("%Y%m%d%H%M")


@SETTINGS
@given(st.lists(record, min_size=30, max_size=30))
def test_render_then_parse_is_identity(spark, recs):
    df = spark.createDataFrame([(i, render(r)) for i, r in enumerate(recs)], "i int, value string")
    parsed = parse_lines(df, keep_line=True).collect()
    by_line = {p["line"]: p for p in parsed}
    for r in recs:
        p = by_line[render(r)]
        assert p["_reason"] is None
        got = (p["ip"], p["method"], p["url"], p["status"], p["bytessent"], p["referer"], p["ua"])
        assert got == (r["ip"], r["method"], r["url"], r["status"], r["bytes"], r["referer"], r["ua"])
        assert p["formattime"] == expected_formattime(r)


@SETTINGS
@given(st.lists(st.text(max_size=30), min_size=20, max_size=20))
def test_crc32_key_equals_zlib(spark, infos):
    df = spark.createDataFrame([(s,) for s in infos], "info string")
    got = [r["k"] for r in df.select(crc32_key(F.lit("d"), F.col("info")).alias("k")).collect()]
    assert got == [f"d_{zlib.crc32(s.encode('utf-8'))}" for s in infos]


@st.composite
def ranges_and_ips(draw):
    cuts = sorted(draw(st.sets(st.integers(0, 2 ** 32 - 1), min_size=2, max_size=40)))
    ranges = []
    for i in range(0, len(cuts) - 1, 2):
        ranges.append((cuts[i], cuts[i + 1], f"c{i}", "p", f"city{i}"))
    ips = draw(st.lists(st.integers(0, 2 ** 32 - 1), min_size=20, max_size=20))
    ips += [lo for lo, *_ in ranges] + [hi for _, hi, *_ in ranges]
    return ranges, ips


def ip_text(n):
    return f"{n >> 24 & 255}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255}"


@SETTINGS
@given(ranges_and_ips())
def test_bucketed_range_join_equals_brute_force(spark, case):
    ranges, ips = case
    geo = spark.createDataFrame(ranges, GEO_RANGE)
    df = spark.createDataFrame([(i, ip_text(n)) for i, n in enumerate(ips)], "i int, ip string")
    got = {r["i"]: r["city"] for r in enrich_geo(df, geo).collect()}
    for i, n in enumerate(ips):
        want = next((c for lo, hi, _, _, c in ranges if lo <= n <= hi), None)
        assert got[i] == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "hot"]), st.integers(0, 5), st.text(max_size=3)),
                min_size=1, max_size=60))
def test_dedup_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "key string, ts int, v string")
    got = {r["key"]: (r["ts"], r["v"], r["hits"]) for r in latest_per_key(df, ["key"], ["ts"]).collect()}
    want = {}
    for k in {d[0] for d in data}:
        rows = [d for d in data if d[0] == k]
        best = max(rows, key=lambda d: (d[1], d[2].encode("utf-8")))
        want[k] = (best[1], best[2], len(rows))
    assert got == want
