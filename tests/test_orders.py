"""Order metrics on the FIXTURES §5 rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loglark.operators import order_metrics as om
from loglark.sources.orders import order_facts, parse_order_json, quarantined_orders

RECORDS = [
    '{"time":"20190130121301","userid":"1","courseid":"2","orderid":"o1","fee":"100","flag":"1"}',
    '{"time":"20190130121359","userid":"1","courseid":"2","orderid":"o2","fee":"50","flag":"0"}',
    '{"time":"20190130130000","userid":1,"courseid":2,"orderid":"o3","fee":20,"flag":1}',
    '{"time":"20190131000000","userid":"1","courseid":"2","orderid":"o4","fee":"7","flag":"0"}',
    '{"time":"20190130121400","userid":"1","courseid":"2","orderid":"o5","flag":"0"}',
    '{"time":"2019","userid":"1","courseid":"2","orderid":"o6","fee":"5","flag":"1"}',
    'oops',
    '{"time":"20190131000059","userid":"1","courseid":"2","orderid":"o8","fee":"9"}',
]


@pytest.fixture(scope="module")
def facts(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    return order_facts(parse_order_json(df))


def test_quarantine(spark):
    extra = ['{"time":"20190130121301","fee":"x","flag":"1"}', "[1,2]", "", None, '"text"']
    df = spark.createDataFrame([(r,) for r in RECORDS + extra], "value string")
    p = parse_order_json(df)
    q = rows(quarantined_orders(p), "reason", "orderid")
    assert q == sorted([("bad_time", "o6"), ("bad_fee", None)] + [("bad_json", None)] * 5, key=repr)
    assert p.where(F.col("_reason").isNull()).count() + len(q) == len(RECORDS) + len(extra)


def test_by_day(facts):
    assert rows(om.metrics_by(facts, "day")) == [("20190130", 4, 2, 120), ("20190131", 2, 0, 0)]


def test_by_hour(facts):
    assert rows(om.metrics_by(facts, "day", "hour")) == [
        ("20190130", "12", 3, 1, 100), ("20190130", "13", 1, 1, 20), ("20190131", "00", 2, 0, 0)]


def test_by_minute(facts):
    got = {(d, h, m): t for d, h, m, t, _, _ in rows(om.minute_metrics(facts))}
    assert got == {("20190130", "12", "13"): 2, ("20190130", "12", "14"): 1,
                   ("20190130", "13", "00"): 1, ("20190131", "00", "00"): 2}


def test_paid_ratio_and_single_metrics(facts):
    r = rows(om.with_paid_ratio(om.metrics_by(facts, "day")), "day", "paid_ratio")
    assert r == [("20190130", 0.5), ("20190131", 0.0)]
    assert rows(om.paid_count(facts, "day")) == [("20190130", 2), ("20190131", 0)]
    assert rows(om.paid_fee(facts, "day")) == [("20190130", 120), ("20190131", 0)]


def test_rollup_equals_three_passes(facts):
    a = rows(om.rollup_metrics(facts).where("level < 7"), "day", "hour", "minute", "total", "success", "fee", "level")
    b = rows(om.rollup_three_passes(facts), "day", "hour", "minute", "total", "success", "fee", "level")
    assert a == b
    grand = om.rollup_metrics(facts).where("level = 7").first()
    assert (grand["total"], grand["success"], grand["fee"]) == (6, 2, 120)


def test_day_over_day(facts):
    r = {x["day"]: x for x in om.day_over_day(om.metrics_by(facts, "day")).collect()}
    assert r["20190130"]["prev_total"] is None
    assert (r["20190131"]["prev_total"], r["20190131"]["delta_total"], r["20190131"]["pct_total"]) == (4, -2, -50.0)


def test_counters(facts):
    hc = {(k, f): v for k, f, v in rows(om.hash_counters(om.minute_metrics(facts)))}
    assert hc[("orders-20190130", "total")] == 4 and hc[("orders-20190130", "fee")] == 120
    assert hc[("orders-20190130", "success12")] == 1 and hc[("orders-20190131", "total00")] == 2
    assert hc[("orders-20190131", "success")] == 0  # a day with no paid order still has its key
    sc = dict(rows(om.string_counters(om.metrics_by(facts, "day"))))
    assert sc == {"paid-count-20190130": 2, "paid-fee-20190130": 120, "paid-count-20190131": 0,
                  "paid-fee-20190131": 0}


def test_windows(facts):
    t = rows(om.window_metrics(facts, "1 hour"), "window_start", "total")
    assert t == [("2019-01-30 12:00:00", 3), ("2019-01-30 13:00:00", 1), ("2019-01-31 00:00:00", 2)]
    s = dict(rows(om.window_metrics(facts, "1 hour", "30 minutes"), "window_start", "success"))
    assert s["2019-01-30 11:30:00"] == 1 and s["2019-01-30 12:00:00"] == 1 and s["2019-01-30 12:30:00"] == 1


def test_impossible_calendar_time_is_quarantined(spark):
    recs = ['{"time":"20191399000000","fee":"1","flag":"1"}', '{"time":"20190130000000","fee":"1","flag":"1"}',
            '{"time":"201901301205","fee":"2","flag":"1"}']
    p = parse_order_json(spark.createDataFrame([(r,) for r in recs], "value string"))
    assert rows(quarantined_orders(p), "reason", "time") == [("bad_time", "20191399000000")]
    f = order_facts(p)
    assert rows(om.metrics_by(f, "day")) == [("20190130", 2, 2, 3)]
    assert rows(om.window_metrics(f, "1 hour"), "window_start", "total") == [
        ("2019-01-30 00:00:00", 1), ("2019-01-30 12:00:00", 1)]


def test_counters_map_view(facts):
    m = {r["key"]: r["fields"] for r in om.counters_as_map(om.hash_counters(om.minute_metrics(facts))).collect()}
    assert m["orders-20190130"]["total"] == 4 and m["orders-20190130"]["fee13"] == 20
    assert set(m["orders-20190131"]) == {"total", "success", "fee", "total00", "success00", "fee00"}


def test_sliding_windows_expand_panes_not_orders(spark):
    import pytest

    from loglark.operators.order_metrics import interval_seconds, window_metrics
    times = ["20190130115959", "20190130120000", "20190130122959", "20190130123000", "20190130125959"]
    df = spark.createDataFrame([(t, 1, 1, i) for i, t in enumerate(times, 1)], "time string, total int, success int, fee int")
    got = window_metrics(df, "1 hour", "30 minutes")
    assert sorted((r.window_start[11:16], r.window_end[11:16], r.total, r.fee) for r in got.collect()) == [
        ("11:00", "12:00", 1, 1), ("11:30", "12:30", 3, 6), ("12:00", "13:00", 4, 14), ("12:30", "13:30", 2, 9)]
    odd = window_metrics(df, "1 hour", "25 minutes").collect()  # panes of five minutes
    assert sum(r.total for r in odd) >= 2 * len(times)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # an aggregate lies below the expansion
    assert interval_seconds("2 days 30 minutes") == 2 * 86400 + 1800
    with pytest.raises(ValueError):
        interval_seconds("1 month")
