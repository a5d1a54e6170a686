"""Traffic counts: order of results, unique browser_stat keys."""

from conftest import rows
from loglark.operators import traffic
from loglark.sources.orders import parse_order_json

TABLE = [("20190130", "Chrome", 2), ("20190130", "Chrome", 1), ("20190130", None, 1), ("20190130", "Unknown", 1),
         ("20190131", "Safari", 5), ("20190131", "Firefox", 1)]


def _table(spark):
    return spark.createDataFrame(TABLE, "day string, browsername string, hits long")


def test_browser_visits_are_ranked(spark):
    expected = [("Chrome", 1), ("Firefox", 2), ("Safari", 3), ("Unknown", 4), (None, 5)]
    for df in (traffic.browser_visits(_table(spark)), traffic.browser_visits_sql(spark, _table(spark))):
        assert [(r["browsername"], r["rank"]) for r in df.collect()] == expected


def test_browser_stat_has_one_row_per_key(spark):
    assert rows(traffic.browser_stat(_table(spark)), "day", "browser", "cnt") == [
        ("20190130", "Chrome", 2), ("20190130", "Unknown", 2), ("20190131", "Firefox", 1), ("20190131", "Safari", 1)]


def test_json_is_parsed_once(spark):
    from loglark.operators.order_metrics import metrics_by
    from loglark.sources.orders import order_facts

    df = metrics_by(order_facts(parse_order_json(spark.createDataFrame([("{}",)], "value string"))), "day")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1


def test_keywords_are_decoded_and_all_counted(spark):
    from loglark.operators.traffic import query_keyword_counts
    urls = ["http://a.b/?q=a+b", "http://a.b/?q=a%20b&q=c", "http://a.b/?x=1&q=", "http://a.b/?q=%zz", "http://a.b/", "not a url ?q=9 %", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {(r.param, r.keyword): r.cnt for r in query_keyword_counts(df, "url", ["q"]).collect()}
    assert got == {("q", "a b"): 2, ("q", "c"): 1, ("q", ""): 1}  # %zz makes the URL malformed
