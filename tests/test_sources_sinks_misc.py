"""Record sinks (K7), the streaming generator (S5/P20), table creation."""

import json

import pytest

from loglark.operators import cells as kv
from loglark.session import new_scratch
from loglark.sinks.records import kafka_available, to_json_records, write_json_records, write_kafka
from loglark.sources.generator import generate_order_stream
from loglark.sources.orders import order_facts, parse_order_json


def test_json_records_round_trip(spark):
    df = spark.createDataFrame([("20190130121301", "1", None)], "time string, fee string, flag string")
    path = new_scratch(spark, "test-json")
    write_json_records(df, path)
    back = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert back == [{"time": "20190130121301", "fee": "1"}]  # NULL fields are left out
    assert to_json_records(df).columns == ["value"]


def test_kafka_is_gated(spark):
    if kafka_available(spark):
        pytest.skip("Kafka connector present")
    with pytest.raises(RuntimeError):
        write_kafka(spark.createDataFrame([("x",)], "v string"), "localhost:1", "t")


def test_rate_generator_stream(spark):
    root = new_scratch(spark, "test-rate")
    s = generate_order_stream(spark, rows_per_second=50, seed=1)
    q = (order_facts(parse_order_json(s)).writeStream.format("memory").queryName("gen_rate_test")
         .option("checkpointLocation", root + "/ckpt").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT count(*) AS n, max(fee) AS f FROM gen_rate_test").first()
    assert got["n"] >= 0 and (got["f"] is None or 0 <= got["f"] <= 399)


def test_create_table_if_missing(spark):
    path = new_scratch(spark, "test-create")
    t = kv.create_table_if_missing(spark, path)
    assert t.count() == 0 and t.columns == ["rowkey", "family", "qualifier", "value", "ts"]
    assert kv.create_table_if_missing(spark, path).count() == 0


def test_scale_settings():
    from loglark.session import scale_settings
    s = scale_settings(150 << 30, 8000)
    assert s["spark.sql.shuffle.partitions"] == "24000"
    assert scale_settings(100 << 40, 8000)["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
