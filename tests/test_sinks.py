"""Replace-a-day table writes (K2, M7)."""

from conftest import rows
from loglark.session import new_scratch
from loglark.sinks.tables import read_day_table, replace_day, replace_days

SCHEMA = "rowkey string, v string"
FULL = "rowkey string, v string, day string"


def test_rerun_and_empty_rerun(spark):
    path = new_scratch(spark, "test-days")
    d1 = spark.createDataFrame([("a", "1"), ("b", "2")], SCHEMA)
    d2 = spark.createDataFrame([("c", "3")], SCHEMA)
    replace_day(d1, path, "20190130")
    replace_day(d2, path, "20190131")
    replace_day(d1, path, "20190130")  # the same day twice
    t = read_day_table(spark, path, spark.createDataFrame([], FULL).schema)
    assert rows(t) == [("a", "1", "20190130"), ("b", "2", "20190130"), ("c", "3", "20190131")]
    replace_day(d1.limit(0), path, "20190130")  # rerun with no rows empties the day
    t = read_day_table(spark, path, spark.createDataFrame([], FULL).schema)
    assert rows(t) == [("c", "3", "20190131")]


def test_backfill_clears_missing_days(spark):
    path = new_scratch(spark, "test-backfill")
    df = spark.createDataFrame([("a", "1", "20190130"), ("c", "3", "20190131")], FULL)
    replace_days(df, path, ["20190130", "20190131"])
    replace_days(df.where("day = '20190131'"), path, ["20190130", "20190131"])
    t = read_day_table(spark, path, df.schema)
    assert rows(t) == [("c", "3", "20190131")]
