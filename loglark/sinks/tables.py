"""File-table sinks (K1, K2, K3).

K2 replace a day: the day's directory is overwritten as a whole, so a rerun
with no rows leaves the day empty (dynamic partition overwrite would keep the
old rows in that case).  Reads use an explicit schema with ``day`` as text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglark.session import shuffles_freed

#: Most cells of a stored file.  Sorted cells are packed so well that a scan split of 128 MB would hold tens of
#: millions of them; Spark adds an opening cost to every file, so a split takes about 25 files of this size.
FILE_CELLS = 200_000


def day_path(table_path: str, day: str) -> str:
    return f"{table_path.rstrip('/')}/day={day}"


def replace_day(rows: DataFrame, table_path: str, day: str) -> None:
    """K2: ``rows`` (without a ``day`` column) become the whole of ``day``."""
    if "day" in rows.columns:
        raise ValueError("drop the day column: the directory names the day")
    rows.write.mode("overwrite").parquet(day_path(table_path, day))


def replace_days(rows: DataFrame, table_path: str, days: Iterable[str] | None = None,
                 rebalance: bool = True) -> list[str]:
    """Backfill of many days in one job (dynamic partition overwrite).

    The days that received rows are observed during the write itself (a
    ``collect_set`` of the partition value, one entry per day), so the input
    is computed once.  Days listed in ``days`` that got no rows are then
    cleared, as a rerun of an empty day must leave it empty.  Returns the
    days written.

    ``rebalance`` adds a ``REBALANCE(day)`` exchange: rows arrive hash
    partitioned on other keys, so without it every task writes a file into
    every day (tasks x days small files).  AQE sizes the rebalanced
    partitions to the advisory size and splits a day that is much larger
    than the others, so a hot day is written by many tasks.
    """
    target = rows if days is None else rows.where(F.col("day").isin(sorted(set(days))))
    if rebalance:
        target = target.hint("rebalance", "day")
    obs = Observation("days_written")
    (target.observe(obs, F.collect_set("day").alias("days"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("day").parquet(table_path))
    written = sorted(obs.get["days"] or [])
    if days is not None:
        empty = rows.drop("day").limit(0)
        for d in sorted(set(days) - set(written)):
            replace_day(empty, table_path, d)
    return written


def read_day_table(spark: SparkSession, table_path: str, schema: T.StructType,
                   days: Iterable[str] | None = None) -> DataFrame:
    """Read with partition pruning on ``day`` (schema holds ``day string``)."""
    df = spark.read.schema(schema).parquet(table_path)
    if days is not None:
        df = df.where(F.col("day").isin(list(days)))
    return df


def table_exists(spark: SparkSession, table_path: str) -> bool:
    try:
        spark.read.schema("day string").parquet(table_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_sorted_cells(cells: DataFrame, path: str, partitions: int | None = None,
                       mode: str = "overwrite", presorted: bool = False) -> None:
    """K3: cells range-partitioned and sorted by (rowkey, family, qualifier, ts),
    so the versions of one hot cell spread over files too.

    Each file covers one key range in order, so Parquet min/max statistics let
    point, range and prefix reads skip row groups and files; a Bloom filter on the row key lets a
    point read skip those whose range holds the key but that do not have it.  Without
    ``partitions`` the number of files follows the bytes: ranges are cut for the session's
    shuffle partitions, and AQE joins neighbours up to its advisory size.  A range of more than
    ``FILE_CELLS`` cells becomes several files, which bounds what a task that reads the table has to sort.
    ``presorted`` cells (``cells.to_sorted_cells``) are in this order and are written as they come.
    """
    order = ["rowkey", "family", "qualifier", "ts"]
    if not presorted:
        ranged = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
        cells = ranged.sortWithinPartitions(*order)
    with shuffles_freed(cells.sparkSession):
        (cells.write.mode(mode).option("maxRecordsPerFile", FILE_CELLS)
               .option("parquet.bloom.filter.enabled#rowkey", "true").parquet(path))
