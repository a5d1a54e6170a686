"""The daily ETL job end to end."""

import pytest
from pyspark.sql import functions as F

from loglark.plans import etl
from loglark.plans.etl import run_access_etl
from loglark.schemas import ACCESS_TABLE_WITH_DAY, GEO_RANGE
from loglark.session import new_scratch
from loglark.sinks.tables import read_day_table
from loglark.sources.access_log import good_rows, parse_lines
from test_access_log import CASES, line


def test_daily_job_and_rerun(spark):
    root = new_scratch(spark, "test-etl")
    data = list(CASES.values()) + [line(time="30/Jan/2019:00:05:00 +0800")]  # same key, later time
    spark.createDataFrame([(x,) for x in data], "value string").coalesce(2).write.text(root + "/in/20190130")
    geo = spark.createDataFrame([(16909056, 16909311, "CN", "BJ", "BJ")], GEO_RANGE)  # 1.2.3.0 - 1.2.3.255
    table = root + "/access"
    run_access_etl(spark, root + "/in/20190130/*", table, "20190130", geo)
    t = read_day_table(spark, table, ACCESS_TABLE_WITH_DAY)
    assert t.select("day").distinct().collect()[0]["day"] == "20190130"
    assert t.where(F.col("country") != "CN").count() == 0
    # 'normal', 'upstream_dashes' and the later copy share referer+url+ip+ua: one row, latest time, 3 hits
    key = t.where((F.col("url") == "/shop/items?page=3") & (F.col("referer") == "https://www.example.com/")
                  & (F.col("browsername") == "Chrome"))
    r = key.collect()
    assert len(r) == 1 and r[0]["formattime"] == "201901300005" and r[0]["hits"] == 3
    assert r[0]["rowkey"].startswith("20190130_")
    q = spark.read.parquet(table + "_quarantine")
    assert q.count() == 5
    first = sorted(map(tuple, t.collect()))
    run_access_etl(spark, root + "/in/20190130/*", table, "20190130", geo)  # rerun: same table
    assert sorted(map(tuple, read_day_table(spark, table, ACCESS_TABLE_WITH_DAY).collect())) == first


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_backfill_keeps_other_days_and_their_quarantine(spark):
    root = new_scratch(spark, "test-backfill")
    geo = spark.createDataFrame([(16909056, 16909311, "CN", "BJ", "BJ")], GEO_RANGE)
    first = [line(ip=f"1.2.3.{i}", time="30/Jan/2019:12:00:00 +0800") for i in range(50)] + ["not a line"]
    second = [line(ip=f"1.2.4.{i}", time="31/Jan/2019:12:00:00 +0800") for i in range(7)]
    second += [line(ip="1.2.3.99", time="30/Jan/2019:23:59:59 +0800"), "junk", line(time="31/Jan/2019:01:00:00 +0800", status="OK")]
    _lines(spark, root + "/in/1", first)
    _lines(spark, root + "/in/2", second)
    table = root + "/access"
    run_access_etl(spark, root + "/in/1", table, "20190130", geo, "md5")
    for _ in range(2):  # a repeated backfill changes nothing more
        run_access_etl(spark, root + "/in/2", table, None, geo, "md5", days=["20190131"])
    days = {r["day"]: r["count"] for r in read_day_table(spark, table, ACCESS_TABLE_WITH_DAY).groupBy("day").count().collect()}
    assert days == {"20190130": 50, "20190131": 7}
    assert spark.read.parquet(table + "_other_days").count() == 1  # the straggler
    run_access_etl(spark, root + "/in/1", table, "20190130", geo, "md5")
    bad = {r["day"]: r["count"] for r in spark.read.schema("reason string, line string, day string")
           .parquet(table + "_quarantine").groupBy("day").count().collect()}
    assert bad == {"20190130": 1, "20190131": 1, "unlisted-20190131-20190131": 1}
    with pytest.raises(ValueError):
        run_access_etl(spark, root + "/in/2", table, None, geo, "md5")  # an existing table needs listed days


def test_overlapping_geo_ranges_stop_the_job(spark):
    root = new_scratch(spark, "test-overlap")
    _lines(spark, root + "/in", [line()])
    geo = spark.createDataFrame([(16909056, 16909311, "CN", "BJ", "BJ"), (16909300, 16909400, "CN", "SH", "SH")], GEO_RANGE)
    with pytest.raises(ValueError):
        run_access_etl(spark, root + "/in", root + "/t", "20190130", geo)


def test_two_backfills_of_the_same_days_keep_both_their_stragglers(spark):
    root = new_scratch(spark, "test-backfill-twice")
    geo = spark.createDataFrame([(16909056, 16909311, "CN", "BJ", "BJ")], GEO_RANGE)
    for i in (1, 2):
        _lines(spark, f"{root}/in/{i}", [line(ip=f"1.2.3.{i}", time=f"{d}/Jan/2019:12:00:00 +0800") for d in (29, 30, 31)])
    table = root + "/access"
    staged = lambda: {n for n in spark._jvm.java.io.File(root.rsplit("/", 1)[0]).list() if n.startswith("access-staged")}
    before = staged()
    for i in (1, 2, 2):
        run_access_etl(spark, f"{root}/in/{i}", table, None, geo, "md5", days=["20190129", "20190131"])
    assert sorted(r["ip"] for r in spark.read.parquet(table + "_other_days").collect()) == ["1.2.3.1", "1.2.3.2"]
    assert staged() == before  # the staged copies are gone


def _tied_lines():
    """Keys on several lines, with ties in time and bytes, no geo, odd agents, keys that are equal as joined text, and bad lines."""
    data = [line(ip=f"1.2.3.{i % 40}", time=f"30/Jan/2019:23:{i % 7:02d}:00 +0800", nbytes=str(i % 3), status="200" if i % 2 else "404",
                 req=f"GET /p/{i % 5} HTTP/1.1") for i in range(600)]
    data += [line(ip=f"9.9.9.{i % 4}", time="31/Jan/2019:00:00:00 +0800", nbytes="-", ua="curl/8.4.0") for i in range(30)]
    data += [line(referer="a", req="GET bc HTTP/1.1"), line(referer="ab", req="GET c HTTP/1.1"), line(ip="not-an-ip"), "not a line", ""]
    return data


@pytest.mark.parametrize("algo", ["crc32", "md5"])
@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_narrow_dedup_gives_the_rows_of_the_wide_one(spark, algo, broadcast_rows):
    geo = spark.createDataFrame([(16909056, 16909071, "CN", "BJ", "BJ"), (16909072, 16909311, "CN", "SH", None)], GEO_RANGE)
    good = good_rows(parse_lines(spark.createDataFrame([(x,) for x in _tied_lines()], "value string"), zone="+05:30"))
    wide = etl.stored_rows(etl.clean_access(good, geo, None, algo))
    narrow = etl.full_rows(etl.latest_rows(good, None, algo), geo, algo, "+05:30", broadcast_rows)
    assert narrow.columns == wide.columns
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(narrow) == rows(wide) and narrow.count() > 40


def test_dedup_shuffles_no_derived_columns_and_staged_files_are_small(spark, monkeypatch):
    root = new_scratch(spark, "test-etl-narrow")
    _lines(spark, root + "/in", _tied_lines())
    geo = spark.createDataFrame([(16909056, 16909311, "CN", "BJ", "BJ")], GEO_RANGE)
    monkeypatch.setattr(etl, "STAGED_FILE_ROWS", 100)
    seen = {}
    dedup, write = etl.latest_per_key, etl._write_outputs

    def kept_dedup(df, keys, order):
        seen["columns"] = df.columns
        return dedup(df, keys, order)

    def kept_write(good, bad, *rest):
        files = good.groupBy(F.input_file_name()).count().collect()
        seen["files"], seen["good"], seen["bad"] = [r["count"] for r in files], good.count(), bad.count()
        write(good, bad, *rest)

    monkeypatch.setattr(etl, "latest_per_key", kept_dedup)
    monkeypatch.setattr(etl, "_write_outputs", kept_write)
    run_access_etl(spark, root + "/in", root + "/t", None, geo, "md5")
    assert not {"country", "province", "city", "formattime", "rowkey", "ua"} & set(seen["columns"])
    assert max(seen["files"]) <= 100 and (seen["good"], seen["bad"]) == (633, 2)
    t = read_day_table(spark, root + "/t", ACCESS_TABLE_WITH_DAY)
    assert {r["day"]: r["n"] for r in t.groupBy("day").agg(F.sum("hits").alias("n")).collect()} == {"20190130": 603, "20190131": 30}
    assert spark.read.parquet(root + "/t_quarantine").count() == 2
