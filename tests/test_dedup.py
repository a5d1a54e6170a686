"""Latest row per key (W1, M2) incl. a hot key holding a third of all rows."""


from loglark.operators.dedup import latest_per_key


def test_latest_and_hits_with_hot_key(spark):
    data = [("hot", i, f"v{i}") for i in range(3000)]
    data += [(f"k{i}", i % 7, f"w{i}") for i in range(6000)]
    data += [("tie", 5, "a"), ("tie", 5, "b")]
    df = spark.createDataFrame(data, "key string, ts int, v string").repartition(8)
    out = {r["key"]: r for r in latest_per_key(df, ["key"], ["ts"]).collect()}
    assert len(out) == 6002
    assert (out["hot"]["ts"], out["hot"]["v"], out["hot"]["hits"]) == (2999, "v2999", 3000)
    assert (out["tie"]["v"], out["tie"]["hits"]) == ("b", 2)  # ties broken by the other columns


def test_partial_aggregation_in_plan(spark):
    df = spark.createDataFrame([("a", 1, "x")], "key string, ts int, v string")
    plan = latest_per_key(df, ["key"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "partial_count" in plan
