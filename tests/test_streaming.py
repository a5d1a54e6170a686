"""Exactly-once counters and windows over file streams."""


from conftest import rows
from loglark.session import new_scratch
from loglark.streaming import counters as sc
from loglark.streaming.sources import max_offsets_per_trigger, order_stream_from_files
from loglark.streaming.windows import windowed_orders
from test_orders import RECORDS


def _write_files(spark, root, groups):
    for i, g in enumerate(groups):
        spark.createDataFrame([(r,) for r in g], "value string").coalesce(1).write.text(f"{root}/part-{i:03d}")


def _run(spark, src, deltas, ckpt):
    q = sc.start_order_counters(order_stream_from_files(spark, src + "/*", max_files_per_trigger=1), deltas,
                                checkpoint=ckpt, quarantine_path=deltas + "_quarantine", available_now=True)
    q.awaitTermination()


def _counters(spark, deltas):
    return rows(sc.hash_counter_view(spark, deltas)), rows(sc.string_counter_view(spark, deltas))


def test_one_batch_many_batches_and_replay_agree(spark):
    root = new_scratch(spark, "test-stream")
    _write_files(spark, root + "/one", [RECORDS])
    _write_files(spark, root + "/many", [[r] for r in RECORDS])
    _run(spark, root + "/one", root + "/d1", root + "/c1")
    _run(spark, root + "/many", root + "/d2", root + "/c2")
    _run(spark, root + "/many", root + "/d2", root + "/c3")  # full replay into the same deltas
    a, b = _counters(spark, root + "/d1"), _counters(spark, root + "/d2")
    assert a == b
    hc = {(k, f): v for k, f, v in a[0]}
    assert hc[("orders-20190130", "total")] == 4 and hc[("orders-20190130", "fee")] == 120
    q = spark.read.parquet(root + "/d2_quarantine")
    assert q.count() == 2  # short time, not JSON


def test_retried_batch_does_not_double_count(spark):
    root = new_scratch(spark, "test-sink")
    sink = sc.OrderCounterSink(root + "/deltas")
    batch = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    sink(batch, 0)
    first = _counters(spark, root + "/deltas")
    sink(batch, 0)  # the same batch again, as after a failure before commit
    assert _counters(spark, root + "/deltas") == first


def test_compaction(spark):
    root = new_scratch(spark, "test-compact")
    sink = sc.OrderCounterSink(root + "/deltas")
    for i, r in enumerate(RECORDS):
        sink(spark.createDataFrame([(r,)], "value string"), i)
    full = rows(sc.minute_totals(spark, root + "/deltas"))
    assert sc.latest_compaction(spark, root + "/compact") is None
    sc.compact_deltas(spark, root + "/deltas", 3, root + "/compact")
    assert rows(sc.minute_totals_compacted(spark, root + "/deltas", root + "/compact")) == full
    sc.compact_deltas(spark, root + "/deltas", 6, root + "/compact")  # incremental on top of upto=3
    assert sc.latest_compaction(spark, root + "/compact") == 6
    assert rows(sc.minute_totals_compacted(spark, root + "/deltas", root + "/compact")) == full
    sink(spark.createDataFrame([(RECORDS[0],)], "value string"), 2)  # a replay below the fold: ignored
    assert rows(sc.minute_totals_compacted(spark, root + "/deltas", root + "/compact")) == full


def test_windowed_stream(spark):
    root = new_scratch(spark, "test-window")
    _write_files(spark, root + "/src", [RECORDS])
    w = windowed_orders(order_stream_from_files(spark, root + "/src/*"), "1 hour", watermark="1 hour")
    q = (w.writeStream.outputMode("complete").format("memory").queryName("win_test")
         .option("checkpointLocation", root + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {str(r["window_start"]): r["total"] for r in spark.sql("SELECT * FROM win_test").collect()}
    assert sorted(got.values()) == [1, 2, 3]


def test_rate_conversion():
    assert max_offsets_per_trigger(100, 5, 3) == 1500


def test_windowed_stream_update_sink(spark):
    from loglark.streaming.windows import start_windowed_orders, window_view
    root = new_scratch(spark, "test-window-sink")
    _write_files(spark, root + "/src", [[r] for r in RECORDS])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = start_windowed_orders(order_stream_from_files(spark, root + "/src/*", max_files_per_trigger=1),
                              root + "/out", root + "/ckpt", "1 hour", watermark="2 days", available_now=True,
                              state_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # set around start() only
    q.awaitTermination()
    got = rows(window_view(spark, root + "/out"), "window_start", "total", "success", "fee")
    assert got == [("2019-01-30 12:00:00", 3, 1, 100), ("2019-01-30 13:00:00", 1, 1, 20),
                   ("2019-01-31 00:00:00", 2, 0, 0)]


def test_views_read_the_compaction_and_damage_is_an_error(spark):
    import pytest
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    root = new_scratch(spark, "test-compact-views")
    sink = sc.OrderCounterSink(root + "/deltas")
    for i, r in enumerate(RECORDS):
        sink(spark.createDataFrame([(r,)], "value string"), i)
    before = _counters(spark, root + "/deltas")
    sc.compact_deltas(spark, root + "/deltas", 3)
    assert _counters(spark, root + "/deltas") == before
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(4):  # folded deltas may go
        fs.delete(path(f"{root}/deltas/batch_id={i}"), True)
    assert _counters(spark, root + "/deltas") == before
    # a compaction without its end mark does not count, a damaged one raises
    fs.mkdirs(path(root + "/deltas_compacted/upto=99"))
    assert sc.latest_compaction(spark, root + "/deltas_compacted") == 3
    for f in fs.listStatus(path(root + "/deltas_compacted/upto=3")):
        if f.getPath().getName().endswith(".parquet"):
            out = fs.create(f.getPath(), True)
            out.writeBytes("not parquet")
            out.close()
    with pytest.raises((PySparkException, Py4JJavaError)):
        sc.compact_deltas(spark, root + "/deltas", 5)


def _order(minute, fee):
    return ('{"time":"2019013012%02d00","userid":"1","courseid":"1","orderid":"%d","fee":"%d","flag":"1"}' % (minute, minute, fee))


def _total_fee(spark, deltas):
    return sum(r.fee for r in sc.minute_totals(spark, deltas).collect())


def test_batches_that_come_after_a_fold_count(spark):
    """Fold "up to 5" when 0 and 1 are there; 2 and 3 come later, 3 before 2."""
    deltas = new_scratch(spark, "test-late-batches") + "/deltas"
    sink = sc.OrderCounterSink(deltas)
    put = lambda i, fee: sink(spark.createDataFrame([(_order(i, fee),)], "value string"), i)
    put(0, 3)
    put(1, 4)
    assert sc.compact_deltas(spark, deltas, 5) == 1 and _total_fee(spark, deltas) == 7
    put(3, 20)
    assert sc.compact_deltas(spark, deltas, 5) == 1 and _total_fee(spark, deltas) == 27  # 2 is missing: 3 waits
    put(2, 10)
    assert _total_fee(spark, deltas) == 37
    assert sc.compact_deltas(spark, deltas) == 3 and _total_fee(spark, deltas) == 37
    assert len(sc.drop_folded(spark, deltas)) == 2 and _total_fee(spark, deltas) == 37
    put(0, 3)  # a replay below the fold
    assert _total_fee(spark, deltas) == 37


def test_folder_count_stays_bounded(spark):
    deltas = new_scratch(spark, "test-bounded") + "/deltas"
    sink = sc.OrderCounterSink(deltas, compact_every=3)
    for i in range(14):
        sink(spark.createDataFrame([(_order(i, 1),)], "value string"), i)
        assert _total_fee(spark, deltas) == i + 1
        assert len(sc.committed(spark, deltas, "batch_id")) <= 7 and len(sc.committed(spark, sc.compaction_path(deltas), "upto")) <= 3


def test_late_orders_add_to_their_window_and_are_written(spark):
    from loglark.streaming.windows import OrderWindowSink, start_order_windows, window_totals
    root = new_scratch(spark, "test-late-orders")
    batches = [[_order(0, 1), _order(30, 2)], [_order(15, 4), "oops", _order(25, 8)], [_order(59, 16)], [_order(48, 32), _order(50, 64)]]
    # files are read in the order of their times
    src = root + "/src"
    for i, g in enumerate(batches):
        spark.createDataFrame([(r,) for r in g], "value string").coalesce(1).write.text(f"{src}/part-{i:03d}")

    def run():
        start_order_windows(order_stream_from_files(spark, src + "/*", max_files_per_trigger=1), root + "/out", root + "/late",
                            root + "/bad", root + "/ckpt", "1 hour", watermark="10 minutes", available_now=True).awaitTermination()

    run()
    total = window_totals(spark, root + "/out").collect()
    late = sorted(r.fee for r in spark.read.parquet(root + "/late").collect())
    assert [(r.window_start, r.total, r.fee, r.late) for r in total] == [("2019-01-30 12:00:00", 7, 127, 2)]
    assert late == [4, 32]  # 12:15 after 12:30, 12:48 after 12:59; 12:25 and 12:50 are within ten minutes
    assert spark.read.parquet(root + "/bad").count() == 1
    # the last batch again, as after a lost commit: the same orders are late, nothing counts twice
    sink = OrderWindowSink(root + "/out", root + "/late", root + "/bad", "1 hour", None, "10 minutes")
    sink(spark.createDataFrame([(r,) for r in batches[3]], "value string"), 3)
    assert window_totals(spark, root + "/out").collect() == total
    assert sorted(r.fee for r in spark.read.parquet(root + "/late").collect()) == late
    assert len(sc.committed(spark, root + "/out_highest", "batch_id")) == 2


def test_state_and_batches_of_a_checkpoint(spark):
    from loglark.streaming.state import batches, seen_orders, window_state
    from loglark.streaming.windows import start_windowed_orders, window_view
    root = new_scratch(spark, "test-state")
    good = [r for r in RECORDS if "o6" not in r and r != "oops"]
    _write_files(spark, root + "/src", [[r] for r in good] + [[good[0], good[1]]])  # two orders come again
    q = start_windowed_orders(order_stream_from_files(spark, root + "/src/*", max_files_per_trigger=1), root + "/out", root + "/ckpt",
                              "1 hour", watermark="2 days", available_now=True, state_partitions=2, dedup_orders=True)
    q.awaitTermination()
    view = rows(window_view(spark, root + "/out"), "window_start", "total", "success", "fee")
    assert rows(window_state(spark, root + "/ckpt"), "window_start", "total", "success", "fee") == view
    assert sum(r[1] for r in view) == len(good)
    assert len({r.orderid for r in seen_orders(spark, root + "/ckpt").collect()}) == len(good)
    done = batches(spark, root + "/ckpt").orderBy("batch_id").collect()
    assert [r.batch_id for r in done] == list(range(len(done))) and all(r.committed for r in done)
    assert [r.watermark_ms for r in done] == sorted(r.watermark_ms for r in done) and done[-1].watermark_ms > 0
