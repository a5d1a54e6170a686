"""IP range join (FIXTURES §4, J1)."""

import pytest
from pyspark.sql import functions as F

from loglark.functions.ipaddr import ip_to_long
from loglark.operators.geo import GEO_COLS, enrich_geo, enrich_geo_sorted, overlapping_ranges
from loglark.schemas import GEO_RANGE

A = 16777216


def ip(n):
    return f"{n >> 24 & 255}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255}"


GEO = [
    (10 * A + 5, 10 * A + 300, "C1", "P1", "small"),              # inside one /16
    (20 * A, 23 * A - 1, "C2", "P2", "wide"),                      # across many /16
    (30 * A + 65530, 30 * A + 65540, "C3", "P3", "edge"),          # across a /16 border
]


@pytest.fixture(scope="module")
def geo(spark):
    return spark.createDataFrame(GEO, GEO_RANGE)


CASES = [
    (ip(10 * A + 5), "small"), (ip(10 * A + 300), "small"), (ip(10 * A + 301), None),
    (ip(21 * A + 12345), "wide"), (ip(30 * A + 65535), "edge"), (ip(30 * A + 65536), "edge"),
    ("10.0.1", None), ("10.0.0.256", None), (None, None), ("99.1.1.1", None), ("1.2.3.4.5", None),
]


def enrich_geo_nested_loop(df, geo, ip_col="ip"):
    """The plain range condition, to compare with."""
    left, g = df.withColumn("_ipn", ip_to_long(F.col(ip_col))), geo.alias("_g")
    joined = left.join(g, F.col("_ipn").between(F.col("_g.lo"), F.col("_g.hi")), "left")
    return joined.select(*[F.col(c) for c in df.columns], *[F.col("_g." + c).alias(c) for c in GEO_COLS])


@pytest.mark.parametrize("fn", [enrich_geo, enrich_geo_nested_loop])
def test_cases(spark, geo, fn):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "id int, ip_case struct<ip:string,city:string>")
    df = df.selectExpr("id", "ip_case.ip AS ip", "ip_case.city AS want")
    out = fn(df, geo).collect()
    assert len(out) == len(CASES)
    for r in out:
        assert r["city"] == r["want"], r


def test_shuffle_path_same_result(spark, geo):
    df = spark.createDataFrame([(c[0],) for c in CASES], "ip string")
    a = sorted(map(tuple, enrich_geo(df, geo).collect()), key=repr)
    b = sorted(map(tuple, enrich_geo(df, geo, broadcast_rows=0).collect()), key=repr)
    assert a == b


def test_overlap_check(spark, geo):
    assert overlapping_ranges(geo).count() == 0
    bad = spark.createDataFrame(GEO + [(22 * A, 22 * A + 10, "X", "X", "x")], GEO_RANGE)
    assert overlapping_ranges(bad).count() == 1
    with pytest.raises(ValueError):
        enrich_geo(spark.createDataFrame([("1.1.1.1",)], "ip string"), bad, validate=True)


def test_hot_bucket_is_salted_on_the_shuffle_path(spark, geo):
    """A third of all rows in one /16 bucket and the geo table not broadcast:
    the join key is (bucket, salt), so the hot bucket spreads over the salt
    values; every row keeps exactly its match."""
    hot = [(i, ip(21 * A + (i % 50))) for i in range(30000)]           # one bucket, a third of the rows
    rest = [(30000 + i, ip(20 * A + (i * 7919) % (3 * A))) for i in range(60000)]
    df = spark.createDataFrame(hot + rest, "i int, ip string").repartition(8)
    out = enrich_geo(df, geo, broadcast_rows=0, salt=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "BroadcastExchange" not in plan
    got = {r["city"]: r["count"] for r in out.groupBy("city").count().collect()}
    assert got == {"wide": 90000}
    assert out.count() == 90000
    # the hot bucket's rows are spread over all salt values
    salts = (df.withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(8))).where(F.col("i") < 30000)
               .select("s").distinct().count())
    assert salts == 8


def test_sorted_join_matches_the_nested_loop(spark, geo):
    hot = [(ip(20 * A + 77), f"hot {i}") for i in range(3000)]  # one address on most rows, and many nulls
    spread = [(ip(n), str(n)) for n in range(9 * A, 32 * A, 71_993)]
    df = spark.createDataFrame(hot + spread + [(c, "case") for c, _ in CASES] + [(None, "null")] * 500, "ip string, `run.k` string").repartition(5)
    df = df.withColumn("place", F.lit(1)).withColumn("city", F.lit("replaced"))
    got = enrich_geo_sorted(df, geo)
    want = enrich_geo_nested_loop(df.drop("city").withColumnRenamed("run.k", "r"), geo)
    assert got.columns == ["ip", "run.k", "place", *GEO_COLS]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sorted_join_of_empty_sides(spark, geo):
    none = spark.createDataFrame([], "ip string")
    assert enrich_geo_sorted(none, geo).count() == 0
    rows = spark.createDataFrame([(ip(20 * A),)], "ip string")
    assert enrich_geo_sorted(rows, geo.limit(0)).first()["city"] is None
