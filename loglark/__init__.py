"""loglark: web-log and order analytics as Spark DataFrame / SQL / Structured Streaming code.

Main entry points:

* ``loglark.plans.etl.run_access_etl`` - raw log files -> day-partitioned access table (+ quarantine)
* ``loglark.operators.traffic`` - visits by region, city, browser, version, URL; top-k
* ``loglark.sources.orders`` + ``loglark.operators.order_metrics`` - order metrics, rollup, counters, windows
* ``loglark.streaming.counters`` / ``loglark.streaming.windows`` - exactly-once counters, event-time windows
* ``loglark.operators.cells`` + ``loglark.sinks.tables.write_sorted_cells`` - key-value cell tables
* ``loglark.operators.ranking`` - distributed global row number, product ranking
* ``loglark.jobs`` - command-line jobs; ``loglark.plans.catalog`` - every operator as a query
"""
