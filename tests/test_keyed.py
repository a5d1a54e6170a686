"""Stored table with upserts by key."""

import time

import pytest
from pyspark.sql import functions as F

from loglark.schemas import CELL
from loglark.sinks.keyed import ConflictingCommit, KeyedTable

KEYS = ["rowkey", "family", "qualifier"]


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), CELL, KEYS, "ts")


def cells(spark, *rows):
    return spark.createDataFrame(rows, CELL)


def seen(table):
    return sorted((r.rowkey, r.qualifier, r.value, r.ts) for r in table.read().collect())


def test_puts_and_update_read_back(spark, table):
    assert seen(table) == []
    table.put(cells(spark, ("a", "o", "x", "1", 1), ("a", "o", "x", "2", 2), ("b", "o", "x", "1", 1)))
    table.put(cells(spark, ("b", "o", "x", "9", 5), ("c", "o", "y", None, 1), ("a", "o", "x", "old", 0)))
    assert seen(table) == [("a", "x", "2", 2), ("b", "x", "9", 5), ("c", "y", None, 1)]
    table.update(F.col("rowkey") == "a", {"value": F.lit("moved")}, F.col("ts") + 1)
    assert seen(table) == [("a", "x", "moved", 3), ("b", "x", "9", 5), ("c", "y", None, 1)]
    assert len(table.runs()) == 3


def test_equal_versions_go_to_the_later_put(spark, table):
    table.put(cells(spark, ("a", "o", "x", "zz", 1)))
    table.put(cells(spark, ("a", "o", "x", "aa", 1)))
    assert seen(table) == [("a", "x", "aa", 1)]


def test_compaction_keeps_the_rows_and_vacuum_deletes_old_runs(spark, table):
    for i in range(4):
        table.put(cells(spark, *[(f"k{j:03d}", "o", "x", f"{i}-{j}", i) for j in range(i * 10, i * 10 + 25)]))
    before, old = seen(table), table.runs()
    table.compact()
    assert seen(table) == before and len(table.runs()) == 1
    assert sorted(table.vacuum()) == sorted(old) and table._names("runs") == table.runs()
    assert seen(table) == before
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()
    table.put(cells(spark, ("k000", "o", "x", "new", 9)))
    assert ("k000", "x", "new", 9) in seen(table)


def test_key_filters_reach_every_run(spark, table):
    table.put(cells(spark, ("a", "o", "x", "1", 1)))
    table.put(cells(spark, ("b", "o", "x", "1", 1)))
    plan = table.read().where("rowkey >= 'b'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(rowkey,b)") == 2


def test_two_writers_cannot_commit_the_same_state(spark, table):
    table.put(cells(spark, ("a", "o", "x", "1", 1)))
    with pytest.raises(ConflictingCommit):
        table._commit(["run-x"], 0)
    assert seen(table) == [("a", "x", "1", 1)]


def test_a_run_that_was_not_committed_is_not_seen(spark, table):
    table.put(cells(spark, ("a", "o", "x", "1", 1)))
    table._write_run(cells(spark, ("b", "o", "x", "1", 1)))
    assert seen(table) == [("a", "x", "1", 1)]


def files_in_order(table, run, key):
    """The first and last key of each file of the run, after a check that its rows are sorted (null first, NaN last)."""
    place = lambda v: (v is not None, v != v, 0 if v is None or v != v else v)
    spans = []
    path = table._hadoop.Path(f"{table.path}/runs/{run}")
    for name in [s.getPath().toString() for s in table._fs.listStatus(path) if s.getPath().getName().endswith(".parquet")]:
        keys = [tuple(map(place, r)) for r in table.spark.read.schema(table.schema).parquet(name).select(*key).collect()]
        assert keys == sorted(keys)
        spans += [(keys[0], keys[-1])] if keys else []
    return sorted(spans)


def in_ranges(spans):
    return all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_run_is_made_and_read_with_one_shuffle(spark, table, monkeypatch):
    rows = spark.range(3000).selectExpr("concat('k', id % 1000) AS rowkey", "'o' AS family", "'x' AS qualifier",
                                        "concat('v', id) AS value", "id AS ts")
    plans, make = [], table._run_rows
    monkeypatch.setattr(table, "_run_rows", lambda *a: plans.append(make(*a)) or plans[-1])
    run = table.put(rows)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning(rowkey") == 1
    assert plan.count("Sort [") == 1
    assert seen(table) == sorted((f"k{i}", "x", f"v{i + 2000}", i + 2000) for i in range(1000))
    assert in_ranges(files_in_order(table, run, KEYS))
    table.put(rows.withColumn("value", F.lit("new")).where("id % 1000 < 10"))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning(rowkey") == 1
    table.compact()
    assert seen(table) == sorted((f"k{i}", "x", "new" if i < 10 else f"v{i + 2000}", i + 2000) for i in range(1000))
    assert in_ranges(files_in_order(table, table.runs()[0], KEYS))


def test_shuffles_of_puts_and_compaction_leave_no_files(spark, table):
    before = shuffle_files(spark)
    for i in range(3):
        table.put(cells(spark, *[(f"k{j:03d}", "o", "x", f"{i}-{j}", i) for j in range(i * 10, i * 10 + 25)]))
    table.update(F.col("rowkey") < "k010", {"value": F.lit("moved")}, F.col("ts") + 1)
    table.compact()
    for _ in range(20):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.5)
    assert shuffle_files(spark) <= before


def test_a_hot_key_is_folded_before_it_is_dealt(spark, table, monkeypatch):
    monkeypatch.setattr("loglark.sinks.keyed.HOT_ROWS", 500)
    rows = spark.range(4000).selectExpr("if(id % 4 = 0, 'hot', concat('k', id)) AS rowkey", "'o' AS family", "'x' AS qualifier",
                                        "concat('v', id) AS value", "id AS ts")
    assert table._has_hot_key(rows) and not table._has_hot_key(rows.where("rowkey <> 'hot'"))
    assert not table._has_hot_key(rows.limit(0))
    plan = table._run_rows(rows, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("rangepartitioning") < plan.index("hashpartitioning")
    run = table.put(rows)
    assert seen(table) == sorted([("hot", "x", "v3996", 3996)] + [(f"k{i}", "x", f"v{i}", i) for i in range(4000) if i % 4])
    assert in_ranges(files_in_order(table, run, KEYS))


def test_float_and_null_keys_are_one_row_each(spark, tmp_path):
    schema = "d double, s string, v string, ts bigint"
    t = KeyedTable(spark, str(tmp_path / "f"), spark.createDataFrame([], schema).schema, ["d", "s"], "ts")
    nan = float("nan")
    run = t.put(spark.createDataFrame([(0.0, "a", "old", 1), (-0.0, "a", "new", 2), (nan, "a", "n1", 1), (nan, "a", "n2", 2), (None, None, "x", 1),
                                       *[(float(i), "b", "r", 1) for i in range(1, 200)]], schema))
    assert in_ranges(files_in_order(t, run, ["d", "s"]))
    t.put(spark.createDataFrame([(-0.0, "a", "later", 3), (None, None, "y", 2)], schema))
    for _ in range(2):
        got = {(repr(r.d), r.s): r.v for r in t.read().where("d IS NULL OR d < 1 OR isnan(d)").collect()}
        assert got == {("0.0", "a"): "later", ("nan", "a"): "n2", ("None", None): "y"}
        assert t.read().count() == 202
        t.compact()
