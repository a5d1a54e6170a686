"""Sorting and ranking (FIXTURES §8; O2-O5, P17, P19)."""

import random

from pyspark.sql import functions as F

from loglark.operators.ranking import global_row_number, parse_products, ranked_products


def test_products_price_then_store(spark):
    lines = spark.createDataFrame([("pen 120 40",), ("lamp 3500 6",), ("cup 120 75",), ("desk 48000 2",), ("cable 35 900",)], "value string")
    p = parse_products(lines)
    out = ranked_products(p, "price_store").orderBy("rn").collect()
    assert [r["name"] for r in out] == ["desk", "lamp", "cup", "pen", "cable"]
    assert out[0]["descr"] == "ProductClass(desk, 48000, 2)"
    price_only = ranked_products(p, "price").orderBy("rn").collect()
    assert [r["name"] for r in price_only] == ["desk", "lamp", "cup", "pen", "cable"]  # name breaks the price tie


def test_parse_bad_numbers(spark):
    p = parse_products(spark.createDataFrame([("X notanumber 3",)], "value string")).first()
    assert p["price"] is None and p["store"] == 3


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 5), i) for i in range(3000)]  # heavy ties on k, unique i
    df = spark.createDataFrame(data, "k int, i int")
    out = global_row_number(df, [F.desc("k"), F.asc("i")], "rn", partitions=7).collect()
    expected = sorted(data, key=lambda x: (-x[0], x[1]))
    got = sorted(((r["k"], r["i"], r["rn"]) for r in out), key=lambda x: x[2])
    assert [g[2] for g in got] == list(range(1, len(data) + 1))
    assert [(g[0], g[1]) for g in got] == expected
