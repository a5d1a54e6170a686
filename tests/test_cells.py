"""Key-value cell operators (FIXTURES §3; P7-P10, F1-F8, T1-T4, W2)."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loglark.operators import cells as kv
from loglark.operators.ranking import global_row_number
from loglark.schemas import CELL
from loglark.session import new_scratch
from loglark.sinks.tables import write_sorted_cells

FAMILIES = {"info": ["age", "birthday", "company"], "address": ["country", "province", "city"]}
WIDE = [("row-a", "18", "2000-01-01", "globex", "CN", "BJ", "BJ"),
        ("row-b", "20", "1998-02-02", "acme", "CN", "SH", "SH")]


@pytest.fixture(scope="module")
def cells(spark):
    wide = spark.createDataFrame(WIDE, "rowkey string, age string, birthday string, company string, "
                                       "country string, province string, city string")
    return kv.families_to_cells(wide, FAMILIES, ts=F.lit(1))


def test_put_and_update(spark, cells):
    assert cells.count() == 12 and cells.select("rowkey").distinct().count() == 2
    updated = kv.update_cell(spark, cells, "row-b", "info", "age", "21", 2)
    latest = kv.latest_cells(updated)
    assert latest.count() == 12
    got = dict(rows(kv.get_row(latest, "row-b", "info").select("qualifier", "value")))
    assert got == {"age": "21", "birthday": "1998-02-02", "company": "acme"}


def test_scans(cells):
    assert rows(kv.scan_range(cells, "row-a", "row-b").select("rowkey").distinct()) == [("row-a",)]
    assert rows(kv.scan_prefix_any(cells, ["row-a", "x"]).select("rowkey").distinct()) == [("row-a",)]
    assert rows(kv.scan_from(cells, "row-b").select("rowkey").distinct()) == [("row-b",)]
    assert rows(kv.scan_regex(cells, "^r.*b$").select("rowkey").distinct()) == [("row-b",)]
    assert kv.scan_family(cells, "address").count() == 6
    assert rows(kv.scan_column(cells, "info", "company")) == [("row-a", "globex"), ("row-b", "acme")]
    assert kv.get_row(cells, "row-a", "info", "age").count() == 1
    assert rows(kv.list_families(cells)) == [("address",), ("info",)]


def test_wide_cells_wide_round_trip(spark):
    cols = ["a", "b"]
    wide = spark.createDataFrame([("k1", "1", None), ("k2", "2", "x"), ("k3", None, None)],
                                 "rowkey string, a string, b string")
    c = kv.to_cells(wide, cols, "o")
    assert c.count() == 3  # NULL columns store no cell
    back = kv.cells_to_wide(c, cols, "o")
    assert rows(back) == [("k1", "1", None), ("k2", "2", "x")]  # an all-NULL row vanishes


def test_row_to_map(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert df.select(kv.row_to_map(["a", "b"]).alias("m")).first()["m"] == {"a": "1", "b": "x"}


def test_sorted_store_pushdown(spark, cells):
    path = new_scratch(spark, "test-cells")
    write_sorted_cells(cells, path, partitions=2)
    stored = spark.read.parquet(path)
    q = kv.scan_prefix(stored, "row-b")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(rowkey,row-b)" in plan
    assert q.count() == 6


def test_latest_wide_equals_latest_then_pivot(spark, cells):
    updated = kv.update_cell(spark, cells, "row-b", "info", "age", "21", 2)
    updated = kv.update_cell(spark, updated, "row-a", "info", "company", "zeta", 1)  # a tie on ts: max value
    cols = ["age", "birthday", "company"]
    a = rows(kv.latest_wide(updated, cols, "info"))
    b = rows(kv.cells_to_wide(kv.latest_cells(updated), cols, "info"))
    assert a == b
    assert ("row-b", "21", "1998-02-02", "acme") in a and ("row-a", "18", "2000-01-01", "zeta") in a


def test_get_rows_salted_shuffle_path(spark, cells):
    hot = spark.createDataFrame([("row-a", "info", f"q{i}", str(i), 1) for i in range(600)],
                                "rowkey string, family string, qualifier string, value string, ts long")
    big = kv.put(cells, hot)
    keys = spark.createDataFrame([("row-a",)], "rowkey string")
    a = rows(kv.get_rows(big, keys))
    b = rows(kv.get_rows(big, keys, max_keys=0))  # shuffle path, salted
    assert a == b and len(a) == 606


@pytest.mark.parametrize("pattern,prefixes", [
    ("^2024011[0-5]_[0-9a-f]*0$", [f"2024011{i}_" for i in range(6)]),
    ("^abc", ["abc"]), ("^abc+d", ["abc"]), ("^abc?d", ["ab"]), ("^ab{2}c", ["a"]), (r"^a\.b", ["a.b"]), (r"^a\d", ["a"]),
    ("^[ab][x-z]q", ["axq", "ayq", "azq", "bxq", "byq", "bzq"]), ("^[^a]b", []), ("^a[.]b", ["a"]), ("^a|b", []), ("abc", []),
    ("^(?i)abc", []), ("^a.b", ["a"]), ("^", []),
    ("^[0-9][0-9]x", [str(i) for i in range(10)]),  # a hundred would be too many
])
def test_key_prefixes(pattern, prefixes):
    assert sorted(kv.key_prefixes(pattern)) == prefixes


def test_regex_scan_pushes_its_prefixes(spark, tmp_path):
    import re

    keys = [f"202401{d:02d}_{x}" for d in range(1, 29) for x in ("a0", "b1", "")] + ["x", "2024011", "20240110_0"]
    stored = spark.createDataFrame([(k, "o", "q", "v", 1) for k in keys], CELL)
    stored.write.parquet(str(tmp_path / "c"))
    cells = spark.read.schema(CELL).parquet(str(tmp_path / "c"))
    pattern = "^2024011[0-5]_[0-9a-f]*0$"
    got = kv.scan_regex(cells, pattern)
    assert sorted(r.rowkey for r in got.collect()) == sorted(k for k in keys if re.search(pattern, k))
    plan = got._jdf.queryExecution().executedPlan().toString()  # it shortens the list of pushed filters
    assert "StartsWith(rowkey#" in plan and "ingStartsWith(rowkey,202" in plan.split("PushedFilters: ")[1]


def test_a_large_range_of_sorted_cells_is_cut_into_files(spark, tmp_path, monkeypatch):
    """Files hold a bounded number of cells, also of one hot row, and none is lost."""
    from loglark.schemas import CELL
    from loglark.sinks import tables
    monkeypatch.setattr(tables, "FILE_CELLS", 100, raising=False)
    rows = [(f"k{i % 7}" if i % 3 else "hot", "o", f"q{i % 5}", f"v{i}", i) for i in range(1_000)]
    path = str(tmp_path / "cells")
    write_sorted_cells(spark.createDataFrame(rows, CELL), path)
    back = spark.read.schema(CELL).parquet(path)
    sizes = [r["count"] for r in back.groupBy("_metadata.file_name").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1_000
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_sorted_cells_move_rows_not_cells(spark, tmp_path):
    """the rows are shuffled and sorted before they are cut into cells; the order is that of the cells."""
    columns = ["url", "city", "ip"]
    wide = spark.createDataFrame([(f"k{i * 37 % 101:03d}", f"u{i}", None if i % 3 else "c", "i") for i in range(101)], "rowkey string, url string, city string, ip string")
    cells = kv.to_sorted_cells(wide, columns, "o", partitions=4)
    parts = cells.rdd.glom().collect()
    got = [tuple(r)[:3] for p in parts for r in p]
    assert len(parts) == 4 and got == sorted(got)
    assert sorted(cells.collect()) == sorted(kv.to_cells(wide, columns, "o").collect())
    plan = cells._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Expand") < plan.index("Exchange") and plan.count("Exchange") == 1
    write_sorted_cells(cells, str(tmp_path / "s"), presorted=True)
    assert sorted(spark.read.schema(CELL).parquet(str(tmp_path / "s")).collect()) == sorted(cells.collect())
    numbered = global_row_number(cells, [F.col(c) for c in ("rowkey", "family", "qualifier")], "rn", presorted=True)
    assert [(r["rowkey"], r["family"], r["qualifier"]) for r in sorted(numbered.collect(), key=lambda r: r["rn"])] == got
