"""The query catalogue: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Log lines and
order JSON are rendered from ``events`` by Spark and parsed back with our
operators, so the SQL oracle (computed straight from ``events`` columns) also
checks the parsers.  Queries whose result is compared with the oracle use
md5 row keys (DuckDB has no crc32); the crc32 key is checked in unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.operators import cells as kv
from loglark.operators import order_metrics as om
from loglark.operators import traffic
from loglark.operators.geo import enrich_geo_sorted
from loglark.operators.ranking import global_row_number, parse_products, ranked_products
from loglark.operators.wordcount import word_count
from loglark.plans.etl import clean_access, run_access_etl, stored_rows
from loglark.schemas import ACCESS_TABLE_WITH_DAY, CELL, STORED_FIELDS
from loglark.session import ensure_checkpoint_dir, new_scratch
from loglark.sinks.keyed import KeyedTable
from loglark.sinks.tables import read_day_table, replace_day, replace_days, write_sorted_cells
from loglark.sources import adapters
from loglark.sources.access_log import good_rows, parse_lines, quarantined
from loglark.sources.orders import order_facts, parse_order_json
from loglark.streaming import counters as sc
from loglark.streaming.sources import order_stream_from_files
from loglark.streaming.state import window_state
from loglark.streaming.windows import start_order_windows, start_windowed_orders, window_totals, window_view

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the catalogue queries.
KV_RANGE = ("20240105", "20240108")
KV_PREFIXES = ("20240103_", "20240117_")
KV_ROW_REGEX = "^2024011[0-5]_[0-9a-f]*0$"
REPLACED_DAY = "20240115"
SCAN_FROM = "20240120"
KV_KEY = "0000000042"
KEYWORD_PARAMS = ("page", "ref")
STREAM_FILES = 6



_MATERIALIZED: dict[tuple[str, str, str], str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialized_text(spark: SparkSession, sf_dir: str, kind: str, render) -> DataFrame:
    """Text derived from the tables (log lines, order JSON), written once per
    session into the shared scratch folder and read back like the log files
    and topic dumps the jobs consume in production."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _MATERIALIZED:
        path = new_scratch(spark, kind)
        render().write.mode("overwrite").text(path)
        _MATERIALIZED[key] = path
    return spark.read.text(_MATERIALIZED[key])


def materialized_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return _MATERIALIZED[(spark.sparkContext.applicationId, sf_dir, kind)]


def access_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored day-partitioned access table, written once per session by
    the ETL job (backfill mode) and read back like the analysis jobs read it:
    by partition (day) and by column."""
    key = (spark.sparkContext.applicationId, sf_dir, "access-store")
    if key not in _MATERIALIZED:
        path = new_scratch(spark, "access-store")
        log_lines(spark, sf_dir)
        run_access_etl(spark, materialized_path(spark, sf_dir, "access-log"), path, None, geo(spark, sf_dir),
                       key_algo="md5")
        _MATERIALIZED[key] = path
    return read_day_table(spark, _MATERIALIZED[key], ACCESS_TABLE_WITH_DAY)


def materialized_path_of_store(spark: SparkSession, sf_dir: str) -> str:
    access_store(spark, sf_dir)
    return materialized_path(spark, sf_dir, "access-store")


def cell_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The access cells as a stored key-value table: written once per session
    (K3: range-partitioned and sorted by row key) and read back, so point,
    range and prefix reads are pushed to the Parquet scan."""
    key = (spark.sparkContext.applicationId, sf_dir, "cell-store")
    if key not in _MATERIALIZED:
        path = new_scratch(spark, "cell-store")
        write_sorted_cells(sorted_access_cells(spark, sf_dir), path, presorted=True)
        _MATERIALIZED[key] = path
    return spark.read.schema(CELL).parquet(_MATERIALIZED[key])


# ---- shared derivations -----------------------------------------------------

def events(spark, d):
    return load(spark, d, "events")


def geo(spark, d):
    return adapters.geo_ranges(load(spark, d, "nation"), load(spark, d, "region"))


def log_lines(spark, d):
    return materialized_text(spark, d, "access-log", lambda: adapters.events_to_log_lines(events(spark, d)))


def parsed_log(spark, d, keep_line=False):
    return parse_lines(log_lines(spark, d), keep_line=keep_line)


def clean_log(spark, d, key_algo="md5"):
    return clean_access(parsed_log(spark, d), geo(spark, d), key_algo=key_algo)


def access_table(spark, d, key_algo="md5"):
    return stored_rows(clean_log(spark, d, key_algo))


def order_records(spark, d):
    return materialized_text(spark, d, "order-json", lambda: adapters.events_to_order_json(events(spark, d)))


def facts(spark, d):
    return order_facts(parse_order_json(order_records(spark, d)))


def version_ts(df: DataFrame) -> F.Column:
    return (F.unix_seconds(F.col("time_ts")) * 1000).cast("bigint")


def access_cells(spark, d):
    """The stored access rows as cells of family ``o`` (one version each)."""
    return kv.to_cells(access_store(spark, d), STORED_FIELDS, "o")


def sorted_access_cells(spark, d, partitions=None):
    """``access_cells`` in key order; the store has one row per key."""
    return kv.to_sorted_cells(access_store(spark, d), STORED_FIELDS, "o", partitions=partitions)


def customer_cells(spark, d):
    """A two-family table (D7) from customer: info(name, segment, balance),
    address(nation, region)."""
    c = load(spark, d, "customer")
    n = load(spark, d, "nation")
    r = load(spark, d, "region")
    wide = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("rowkey"),
                     F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                     F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string").alias("balance"),
                     F.col("n_name").alias("nation"), F.col("r_name").alias("region")))
    return kv.families_to_cells(wide, {"info": ["name", "segment", "balance"], "address": ["nation", "region"]})


# ---- orders -----------------------------------------------------------------

def q_orders_daily(spark, d):
    return om.metrics_by(facts(spark, d), "day")


def q_orders_hourly(spark, d):
    return om.metrics_by(facts(spark, d), "day", "hour")


def q_orders_minutely(spark, d):
    return om.minute_metrics(facts(spark, d))


def q_paid_count_daily(spark, d):
    return om.paid_count(facts(spark, d), "day")


def q_paid_fee_daily(spark, d):
    return om.paid_fee(facts(spark, d), "day")


def q_paid_ratio_hourly(spark, d):
    return om.with_paid_ratio(om.metrics_by(facts(spark, d), "day", "hour"))


def q_paid_ratio_daily(spark, d):
    return om.with_paid_ratio(om.metrics_by(facts(spark, d), "day"))


def q_paid_ratio_minutely(spark, d):
    return om.with_paid_ratio(om.minute_metrics(facts(spark, d)))


def q_order_counter_map(spark, d):
    """Each day's counters as one map, compared as its entries."""
    daily = om.metrics_by(facts(spark, d), "day")
    names = ["total", "success", "fee"]
    as_map = daily.select("day", F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))]).alias("m"))
    return as_map.select("day", F.explode("m").alias("field", "value"))


def q_orders_rollup(spark, d):
    return om.rollup_metrics(facts(spark, d)).withColumn("level", F.col("level").cast("bigint"))


def q_orders_day_over_day(spark, d):
    return om.day_over_day(om.metrics_by(facts(spark, d), "day"))


def q_order_hash_counters(spark, d):
    return om.hash_counters(om.minute_metrics(facts(spark, d)))


def q_order_string_counters(spark, d):
    return om.string_counters(om.metrics_by(facts(spark, d), "day"))


def q_order_metric_vectors(spark, d):
    v = om.vector_sum(om.metric_vector(facts(spark, d)), "metrics", 3, "day")
    return v.select("day", *[F.col("metrics").getItem(i).alias(m) for i, m in enumerate(om.METRICS)])


def q_orders_window_tumbling(spark, d):
    return om.window_metrics(facts(spark, d), "1 hour")


def q_orders_window_sliding(spark, d):
    return om.window_metrics(facts(spark, d), "1 hour", "30 minutes")


def _stream_counters(spark, d, replay: bool):
    """Order JSON files -> file stream (one file per micro-batch) -> counters."""
    root = new_scratch(spark, "stream-counters")
    src, deltas = f"{root}/source", f"{root}/deltas"
    order_records(spark, d).repartition(STREAM_FILES).write.mode("overwrite").text(src)
    runs = 2 if replay else 1
    for i in range(runs):
        # a replay restarts from a fresh checkpoint: every batch id is rewritten
        q = sc.start_order_counters(order_stream_from_files(spark, src, max_files_per_trigger=1), deltas,
                                    checkpoint=f"{root}/checkpoint-{i}", available_now=True)
        q.awaitTermination()
    return sc.hash_counter_view(spark, deltas)


STREAM_WATERMARK = "31 days"  # covers the disorder of the derived order files
STREAM_STATE_PARTITIONS = 4  # window state: one row per open window


def q_stream_windows_tumbling(spark, d):
    """X7 as a stream: hourly windows over the order files (one file per
    micro-batch), update mode, latest update per window read back."""
    root = new_scratch(spark, "stream-windows")
    order_records(spark, d)
    src = materialized_path(spark, d, "order-json")
    q = start_windowed_orders(order_stream_from_files(spark, src, max_files_per_trigger=1), root + "/out",
                              root + "/checkpoint", "1 hour", watermark=STREAM_WATERMARK, available_now=True,
                              state_partitions=STREAM_STATE_PARTITIONS)
    q.awaitTermination()
    return window_view(spark, root + "/out")


def _late_windows(spark, d):
    """Order files in hash order (so times jump) through the windows that keep late orders, 10-minute watermark."""
    root = new_scratch(spark, "stream-late")
    src = root + "/source"
    order_records(spark, d).repartition(STREAM_FILES, F.xxhash64("value")).write.text(src)
    start_order_windows(order_stream_from_files(spark, src, max_files_per_trigger=1), root + "/out", root + "/late", root + "/bad",
                        root + "/checkpoint", "1 hour", available_now=True).awaitTermination()
    return root


def q_stream_windows_late(spark, d):
    """Hourly windows to which late orders still add."""
    return window_totals(spark, _late_windows(spark, d) + "/out").drop("late")


def q_stream_late_balance(spark, d):
    """Every record is on time, late (in the late output too) or bad."""
    root = _late_windows(spark, d)
    count = lambda df, name: df.select(F.lit(name).alias("kind"), F.lit(1).cast("bigint").alias("n"))
    kinds = window_totals(spark, root + "/out").select(F.lit("on_time").alias("kind"), (F.col("total") - F.col("late")).alias("n"))
    kinds = kinds.unionByName(count(spark.read.parquet(root + "/late"), "late")).unionByName(count(spark.read.parquet(root + "/bad"), "bad"))
    kinds = kinds.unionByName(count(spark.read.text(root + "/source"), "input"))
    counted = window_totals(spark, root + "/out").select(F.lit("late_in_windows").alias("kind"), F.col("late").alias("n"))
    of = lambda *names: F.coalesce(F.sum(F.when(F.col("kind").isin(*names), F.col("n"))), F.lit(0)).cast("bigint")
    return kinds.unionByName(counted).agg(
        of("input").alias("input"), of("on_time", "late", "bad").alias("accounted"),
        (of("late") == of("late_in_windows")).alias("late_rows_agree"), (of("late") > 0).alias("some_late"))


def _dedup_windows(spark, d):
    root = new_scratch(spark, "stream-dedup")
    src = root + "/source"
    for _ in range(2):  # every record is delivered twice
        order_records(spark, d).repartition(3).write.mode("append").text(src)
    start_windowed_orders(order_stream_from_files(spark, src, max_files_per_trigger=2), root + "/out", root + "/checkpoint", "1 hour",
                          watermark=STREAM_WATERMARK, available_now=True, state_partitions=STREAM_STATE_PARTITIONS,
                          dedup_orders=True).awaitTermination()
    return root


def q_stream_windows_dedup(spark, d):
    """X7 with order ids counted once: the windows of records that all come twice."""
    return window_view(spark, _dedup_windows(spark, d) + "/out")


def q_stream_window_state(spark, d):
    """The window state of the checkpoint itself, after the last commit was lost and the batch ran again."""
    root = new_scratch(spark, "stream-state")
    order_records(spark, d).repartition(3).write.text(root + "/source")

    def run():
        start_windowed_orders(order_stream_from_files(spark, root + "/source", max_files_per_trigger=1), root + "/out",
                              root + "/checkpoint", "1 hour", watermark=STREAM_WATERMARK, available_now=True,
                              state_partitions=STREAM_STATE_PARTITIONS).awaitTermination()

    run()
    last = spark._jvm.org.apache.hadoop.fs.Path(root + "/checkpoint/commits/2")
    last.getFileSystem(spark._jsc.hadoopConfiguration()).delete(last, False)
    run()
    return window_state(spark, root + "/checkpoint")


def q_stream_counters_restart(spark, d):
    """Stop after the last batch, lose its commit record, start again from
    the same checkpoint: the last batch runs a second time and counts once."""
    root = new_scratch(spark, "stream-restart")
    src, deltas, checkpoint = f"{root}/source", f"{root}/deltas", f"{root}/checkpoint"
    order_records(spark, d).repartition(STREAM_FILES).write.mode("overwrite").text(src)

    def run():
        sc.start_order_counters(order_stream_from_files(spark, src, max_files_per_trigger=1), deltas,
                                checkpoint=checkpoint, available_now=True).awaitTermination()

    run()
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{STREAM_FILES - 1}")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, False)
    run()
    return sc.hash_counter_view(spark, deltas)


def _compacted(spark, d):
    root = new_scratch(spark, "stream-compacted")
    src, deltas = f"{root}/source", f"{root}/deltas"
    order_records(spark, d).repartition(STREAM_FILES).write.mode("overwrite").text(src)
    sc.start_order_counters(order_stream_from_files(spark, src, max_files_per_trigger=1), deltas,
                            checkpoint=f"{root}/checkpoint", available_now=True).awaitTermination()
    sc.compact_deltas(spark, deltas, STREAM_FILES // 2)
    return deltas


def q_stream_counters_compacted(spark, d):
    """Half of the batches folded; the view is the fold plus the rest."""
    return sc.hash_counter_view(spark, _compacted(spark, d))


def q_stream_string_counters(spark, d):
    """K5 over a stream, half of it folded."""
    return sc.string_counter_view(spark, _compacted(spark, d))


def q_stream_counters_files(spark, d):
    return _stream_counters(spark, d, replay=False)


def q_stream_counters_replay(spark, d):
    return _stream_counters(spark, d, replay=True)


# ---- access log -------------------------------------------------------------

PARSE_COLS = ["ip", "time", "method", "url", "protocal", "status", "bytessent", "referer", "ua"]


def q_access_parse(spark, d):
    return good_rows(parsed_log(spark, d)).select(*PARSE_COLS)


def q_access_formattime(spark, d):
    return good_rows(parsed_log(spark, d)).select("time", "formattime")


def q_access_quarantine(spark, d):
    return quarantined(parsed_log(spark, d, keep_line=True))


def q_access_rowkey_crc32(spark, d):
    return clean_log(spark, d, key_algo="crc32").select("day", "rowkey")


def q_access_rowkey_md5(spark, d):
    return clean_log(spark, d, key_algo="md5").select("day", "rowkey")


def q_access_dedup(spark, d):
    return access_table(spark, d)


def q_user_agent_stats(spark, d):
    return traffic.agent_visits(access_store(spark, d))


def q_browser_version_stats(spark, d):
    return traffic.browser_version_visits(access_store(spark, d))


def q_geo_enrich(spark, d):
    return clean_log(spark, d).select("ip", "country", "province", "city")


def q_geo_enrich_sorted(spark, d):
    """J1 as a sort-merge interval join: no broadcast table, no buckets."""
    return enrich_geo_sorted(good_rows(parsed_log(spark, d)).select("ip"), geo(spark, d))


def q_geo_unmatched(spark, d):
    return clean_log(spark, d).where(F.col("country").isNull()).select("ip")


def q_region_visits(spark, d):
    return traffic.region_visits(access_store(spark, d))


def q_region_top10(spark, d):
    return traffic.region_top(access_store(spark, d), 10).withColumn("rank", F.col("rank").cast("bigint"))


def q_city_visits(spark, d):
    return traffic.city_visits(access_store(spark, d))


def q_browser_visits_df(spark, d):
    return traffic.browser_visits(access_store(spark, d))


def q_browser_visits_sql(spark, d):
    return traffic.browser_visits_sql(spark, access_store(spark, d))


def q_browser_visits_day(spark, d):
    """S2 + A3: one day of the stored table (partition pruning), three
    columns of it (column pruning), as the daily analysis job reads it."""
    day = read_day_table(spark, materialized_path_of_store(spark, d), ACCESS_TABLE_WITH_DAY, [REPLACED_DAY])
    return traffic.browser_visits(day)


def q_browser_stat_day(spark, d):
    return traffic.browser_stat(access_store(spark, d))


def q_url_clicks(spark, d):
    return traffic.url_clicks(access_store(spark, d))


def q_query_keyword_counts(spark, d):
    return traffic.query_keyword_counts(load(spark, d, "pages"), "url", KEYWORD_PARAMS)


# ---- cells / key-value ------------------------------------------------------

def q_cells_unpivot(spark, d):
    return access_cells(spark, d).select("rowkey", "family", "qualifier", "value")


def _versions(spark, d):
    c = clean_log(spark, d)
    return c.select("rowkey", version_ts(c).alias("ts"), *STORED_FIELDS)


def q_cells_latest_version(spark, d):
    """Every good line is a put of its 15 cells; the lines are reduced
    before they are cut into cells, so one row per line and task is shuffled, not 15."""
    latest = kv.latest_columns(_versions(spark, d), STORED_FIELDS)
    cells = F.array(*[F.struct(F.lit(c).alias("qualifier"), F.col(f"{c}.value").alias("value"), F.col(f"{c}.ts").alias("ts"))
                      for c in STORED_FIELDS])
    return (latest.select("rowkey", F.lit("o").alias("family"), F.inline(cells)).where(F.col("value").isNotNull()))


def q_cells_pivot_back(spark, d):
    return kv.latest_columns(_versions(spark, d), STORED_FIELDS).select(
        "rowkey", *[F.col(f"{c}.value").alias(c) for c in STORED_FIELDS])


def q_cells_to_wide(spark, d):
    """The stored cells read back and pivoted to one row per key."""
    return kv.cells_to_wide(kv.latest_cells(cell_store(spark, d)), STORED_FIELDS, "o")


def q_row_maps(spark, d):
    """Each stored row as one map of its columns, compared as its entries."""
    rows = access_store(spark, d).select("rowkey", kv.row_to_map(STORED_FIELDS).alias("m"))
    return rows.select("rowkey", F.explode("m").alias("qualifier", "value"))


def q_order_counter_fields(spark, d):
    """One map of all counter fields per day key, compared as its entries."""
    maps = om.counters_as_map(om.hash_counters(om.minute_metrics(facts(spark, d))))
    return maps.select("key", F.explode("fields").alias("field", "value"))


def customer_store(spark, sf_dir: str) -> DataFrame:
    """The two-family customer cells as a stored table sorted by row key, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "customer-store")
    if key not in _MATERIALIZED:
        path = new_scratch(spark, "customer-store")
        write_sorted_cells(customer_cells(spark, sf_dir), path)
        _MATERIALIZED[key] = path
    return spark.read.schema(CELL).parquet(_MATERIALIZED[key])


def q_kv_get_stored(spark, d):
    """point get on the sorted store; the key reaches the Parquet scan."""
    return kv.get_row(customer_store(spark, d), KV_KEY).select("rowkey", "family", "qualifier", "value")


def q_kv_get(spark, d):
    """point get of a given key."""
    return kv.get_row(customer_cells(spark, d), KV_KEY).select("rowkey", "family", "qualifier", "value")


def q_kv_multi_get(spark, d):
    """F1 for a key set given as a frame: the keys of one day in the stored
    table (semi join, key frame broadcast after a size check)."""
    store = cell_store(spark, d)
    keys = kv.scan_prefix(store, KV_PREFIXES[0]).select("rowkey")
    return kv.get_rows(store, keys).select("rowkey", "family", "qualifier", "value")


def q_kv_scan_from(spark, d):
    return kv.scan_from(cell_store(spark, d), SCAN_FROM).select("rowkey", "family", "qualifier", "value")


def q_cells_update(spark, d):
    """One column of a key range gets a new version; the newest is read back."""
    old = kv.scan_range(cell_store(spark, d), *KV_RANGE)
    new = (old.where(F.col("qualifier") == "city").withColumn("value", F.lit("moved"))
           .withColumn("ts", F.coalesce(F.col("ts"), F.lit(0)) + 1))
    return kv.latest_cells(old.unionByName(new)).select("rowkey", "family", "qualifier", "value")


def keyed_cells(spark, d) -> KeyedTable:
    """The access cells as a stored keyed table, put in two halves that overlap in one day."""
    table = KeyedTable(spark, new_scratch(spark, "keyed-cells"), CELL, ["rowkey", "family", "qualifier"], "ts")
    cells = cell_store(spark, d)
    table.put(cells.where(F.col("rowkey") < REPLACED_DAY + "~"))
    table.put(cells.where(F.col("rowkey") >= REPLACED_DAY).withColumn("ts", F.col("ts") + 1))
    return table


def q_keyed_update(spark, d):
    """K1/T2 stored: two puts and an update of one column of a key range, merged on read."""
    table = keyed_cells(spark, d)
    hit = F.col("rowkey").between(*KV_RANGE) & (F.col("qualifier") == "city")
    table.update(hit, {"value": F.lit("moved")}, F.col("ts") + 1)
    return table.read().select("rowkey", "family", "qualifier", "value")


def q_keyed_compacted(spark, d):
    """K1 stored: the same table after compaction, its old runs deleted; the last put comes after."""
    table = keyed_cells(spark, d)
    table.compact()
    table.vacuum()
    hit = F.col("rowkey").between(*KV_RANGE) & (F.col("qualifier") == "city")
    table.update(hit, {"value": F.lit("moved")}, F.col("ts") + 1)
    return table.read().where(F.col("rowkey").between(*KV_RANGE)).select("rowkey", "family", "qualifier", "value")


def q_kv_range_scan(spark, d):
    return kv.scan_range(cell_store(spark, d), *KV_RANGE).select("rowkey", "family", "qualifier", "value")


def q_kv_prefix_any(spark, d):
    return kv.scan_prefix_any(cell_store(spark, d), KV_PREFIXES).select("rowkey", "family", "qualifier", "value")


def q_kv_row_regex(spark, d):
    return kv.scan_regex(cell_store(spark, d), KV_ROW_REGEX).select("rowkey", "family", "qualifier", "value")


def q_kv_family_scan(spark, d):
    return kv.scan_family(customer_cells(spark, d), "address").select("rowkey", "family", "qualifier", "value")


def q_kv_column_scan(spark, d):
    return kv.scan_column(customer_cells(spark, d), "info", "segment")


def q_kv_sorted_store_range(spark, d):
    """K3 then F5: cells written range-partitioned and sorted, read back with
    a pushed-down key range."""
    path = new_scratch(spark, "cells-sorted")
    write_sorted_cells(sorted_access_cells(spark, d), path, presorted=True)
    stored = spark.read.parquet(path)
    return kv.scan_range(stored, *KV_RANGE).select("rowkey", "family", "qualifier", "value")


def q_cells_sorted(spark, d):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = sorted_access_cells(spark, d, n).select("rowkey", "family", "qualifier", "value")
    return global_row_number(cells, [F.col("rowkey"), F.col("family"), F.col("qualifier")], "rn", presorted=True)


# ---- ranking ----------------------------------------------------------------

def products(spark, d):
    return parse_products(adapters.part_to_product_lines(load(spark, d, "part")))


def q_product_sort_price_stock(spark, d):
    return ranked_products(products(spark, d), "price_store")


def q_product_sort_price(spark, d):
    return ranked_products(products(spark, d), "price")


# ---- sinks ------------------------------------------------------------------

def _write_days(spark, d, path):
    replace_days(access_store(spark, d), path)
    return read_day_table(spark, path, ACCESS_TABLE_WITH_DAY)


def q_replace_day_twice(spark, d):
    """Write all days, then rerun one day twice with the same rows."""
    ensure_checkpoint_dir(spark)
    path = new_scratch(spark, "access-table")
    stored = _write_days(spark, d, path)
    # the day's rows are cut from the table before it is overwritten
    day_rows = stored.where(F.col("day") == REPLACED_DAY).drop("day").checkpoint(eager=True)
    replace_day(day_rows, path, REPLACED_DAY)
    replace_day(day_rows, path, REPLACED_DAY)
    return read_day_table(spark, path, ACCESS_TABLE_WITH_DAY)


def q_replace_day_empty(spark, d):
    """Write all days, then rerun one day with no rows: that day is emptied."""
    path = new_scratch(spark, "access-table")
    stored = _write_days(spark, d, path)
    replace_day(stored.drop("day").limit(0), path, REPLACED_DAY)
    return read_day_table(spark, path, ACCESS_TABLE_WITH_DAY)


def q_access_etl_backfill(spark, d):
    """The ETL job (read files -> parse -> geo -> agent -> key -> dedup ->
    replace days) over the whole log, then the stored table read back."""
    path = new_scratch(spark, "access-etl")
    log_lines(spark, d)  # make sure the log files exist
    src = materialized_path(spark, d, "access-log")
    run_access_etl(spark, src, path, None, geo(spark, d), key_algo="md5")
    return read_day_table(spark, path, ACCESS_TABLE_WITH_DAY)


def q_access_backfill_keeps_other_days(spark, d):
    """Load all days, then backfill one listed day from the whole log: every
    other day and its quarantine stay as they were."""
    path = new_scratch(spark, "access-etl")
    log_lines(spark, d)
    src = materialized_path(spark, d, "access-log")
    run_access_etl(spark, src, path, None, geo(spark, d), key_algo="md5")
    run_access_etl(spark, src, path, None, geo(spark, d), key_algo="md5", days=[REPLACED_DAY])
    return read_day_table(spark, path, ACCESS_TABLE_WITH_DAY)


# ---- text -------------------------------------------------------------------

def q_word_count(spark, d):
    return word_count(load(spark, d, "documents"), "text")


QUERIES: dict[str, QueryFn] = {
    "orders_daily": q_orders_daily,
    "orders_hourly": q_orders_hourly,
    "orders_minutely": q_orders_minutely,
    "paid_count_daily": q_paid_count_daily,
    "paid_fee_daily": q_paid_fee_daily,
    "paid_ratio_hourly": q_paid_ratio_hourly,
    "paid_ratio_daily": q_paid_ratio_daily,
    "paid_ratio_minutely": q_paid_ratio_minutely,
    "order_counter_map": q_order_counter_map,
    "orders_rollup": q_orders_rollup,
    "orders_day_over_day": q_orders_day_over_day,
    "order_hash_counters": q_order_hash_counters,
    "order_string_counters": q_order_string_counters,
    "order_metric_vectors": q_order_metric_vectors,
    "orders_window_tumbling": q_orders_window_tumbling,
    "orders_window_sliding": q_orders_window_sliding,
    "stream_counters_files": q_stream_counters_files,
    "stream_windows_tumbling": q_stream_windows_tumbling,
    "stream_windows_late": q_stream_windows_late,
    "stream_late_balance": q_stream_late_balance,
    "stream_window_state": q_stream_window_state,
    "stream_windows_dedup": q_stream_windows_dedup,
    "stream_counters_replay": q_stream_counters_replay,
    "stream_counters_restart": q_stream_counters_restart,
    "stream_counters_compacted": q_stream_counters_compacted,
    "stream_string_counters": q_stream_string_counters,
    "access_parse": q_access_parse,
    "access_formattime": q_access_formattime,
    "access_quarantine": q_access_quarantine,
    "access_rowkey_crc32": q_access_rowkey_crc32,
    "access_rowkey_md5": q_access_rowkey_md5,
    "access_dedup": q_access_dedup,
    "user_agent_stats": q_user_agent_stats,
    "browser_version_stats": q_browser_version_stats,
    "geo_enrich": q_geo_enrich,
    "geo_enrich_sorted": q_geo_enrich_sorted,
    "geo_unmatched": q_geo_unmatched,
    "region_visits": q_region_visits,
    "region_top10": q_region_top10,
    "city_visits": q_city_visits,
    "browser_visits_df": q_browser_visits_df,
    "browser_visits_sql": q_browser_visits_sql,
    "browser_visits_day": q_browser_visits_day,
    "browser_stat_day": q_browser_stat_day,
    "url_clicks": q_url_clicks,
    "query_keyword_counts": q_query_keyword_counts,
    "cells_unpivot": q_cells_unpivot,
    "cells_latest_version": q_cells_latest_version,
    "cells_pivot_back": q_cells_pivot_back,
    "cells_sorted": q_cells_sorted,
    "cells_to_wide": q_cells_to_wide,
    "row_maps": q_row_maps,
    "order_counter_fields": q_order_counter_fields,
    "kv_get": q_kv_get,
    "kv_get_stored": q_kv_get_stored,
    "kv_multi_get": q_kv_multi_get,
    "kv_scan_from": q_kv_scan_from,
    "cells_update": q_cells_update,
    "keyed_update": q_keyed_update,
    "keyed_compacted": q_keyed_compacted,
    "kv_range_scan": q_kv_range_scan,
    "kv_prefix_any": q_kv_prefix_any,
    "kv_row_regex": q_kv_row_regex,
    "kv_family_scan": q_kv_family_scan,
    "kv_column_scan": q_kv_column_scan,
    "kv_sorted_store_range": q_kv_sorted_store_range,
    "product_sort_price_stock": q_product_sort_price_stock,
    "product_sort_price": q_product_sort_price,
    "access_etl_backfill": q_access_etl_backfill,
    "access_backfill_keeps_other_days": q_access_backfill_keeps_other_days,
    "replace_day_twice": q_replace_day_twice,
    "replace_day_empty": q_replace_day_empty,
    "word_count": q_word_count,
}
