"""A stored table that is upserted by key (K1, T1, T2): runs, manifest, merge on read, compaction.

A put writes its rows once, as a *run*: Parquet files that are range partitioned and sorted by the
key and hold one row per key.  Rows are shuffled once: dealt by key ranges, sorted and folded there; only rows
among which a key is hot are folded in each task before.  Nothing stored is rewritten.  The manifest names the runs that make up the table, oldest first; each
commit writes the next numbered manifest, and two writers cannot commit the same number.
A read takes, per key, the row with the greatest version, then of the latest run.  Filters on the
key reach the Parquet scan of every run, through the aggregate.  A table of one run has
unique keys and is read without a shuffle.  ``compact`` folds the runs into one, ``vacuum``
deletes what the last manifest no longer names.

    table = KeyedTable(spark, path, CELL, ["rowkey", "family", "qualifier"], "ts")
    table.put(cells)
    table.read().where("rowkey >= '20240105' and rowkey < '20240108'")

A run that was written but not committed (its job failed) is in no manifest: no reader sees it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglark.session import shuffles_freed
from loglark.sinks.tables import FILE_CELLS

#: A put counts its rows in so many classes of keys; a class of ``HOT_ROWS`` rows above twice the usual has a hot key.
KEY_CLASSES = 4096
HOT_ROWS = 100_000


class ConflictingCommit(RuntimeError):
    """Another writer committed first; the put can be tried again."""


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], version: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.version = list(keys), version
        # float keys (0.0 and -0.0 are one key) are grouped by another value than the stored one, nested ones may hold floats:
        # their ranges would be dealt again by hash, so they are folded first
        types = [schema[k].dataType for k in self.keys]
        self._range_keys = all(isinstance(t, T.AtomicType) and not isinstance(t, (T.FloatType, T.DoubleType)) for t in types)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifest ----

    def _names(self, folder: str) -> list[str]:
        where = self._hadoop.Path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _manifests(self) -> list[str]:
        return [n for n in self._names("manifest") if n.endswith(".json") and not n.startswith((".", "_"))]

    def runs(self) -> list[str]:
        """The runs of the table as last committed, oldest first."""
        found = self._manifests()
        if not found:
            return []
        text = self.spark.read.text(f"{self.path}/manifest/{found[-1]}", wholetext=True).first()
        return json.loads(text["value"])["runs"]

    def _commit(self, runs: list[str], after: int) -> None:
        """Write manifest ``after + 1``.  ``create`` without overwrite fails if another writer has it."""
        where = self._hadoop.Path(f"{self.path}/manifest/{after + 1:010d}.json")
        if len(self._manifests()) and int(self._manifests()[-1].split(".")[0]) != after:
            raise ConflictingCommit(f"{self.path} changed since manifest {after}")
        try:
            out = self._fs.create(where, False)
        except Exception as e:
            raise ConflictingCommit(f"{where} exists") from e
        out.write(json.dumps({"runs": runs}).encode())
        out.close()

    def _last(self) -> int:
        found = self._manifests()
        return int(found[-1].split(".")[0]) if found else 0

    # ---- writing ----

    def _has_hot_key(self, rows: DataFrame) -> bool:
        """Whether one key may have so many of the rows that the task of its range would have most of the work."""
        classes = rows.groupBy(F.pmod(F.xxhash64(*self.keys), F.lit(KEY_CLASSES))).agg(F.count(F.lit(1)).alias("n"))
        with shuffles_freed(self.spark):
            n, most = classes.agg(F.sum("n"), F.max("n")).first()
        return n is not None and most > 2 * n / KEY_CLASSES + HOT_ROWS

    def _run_rows(self, rows: DataFrame, fold_first: bool = False) -> DataFrame:
        """The newest row per key, dealt by key ranges (AQE sizes them) and sorted by key: one shuffle, the rows of a
        range are folded there.  ``fold_first`` takes a second one, in which each task sends a key once."""
        if fold_first or not self._range_keys:
            newest = self._newest(rows).repartitionByRange(*self.keys)
        else:
            newest = self._newest(rows.repartitionByRange(*self.keys))
        return newest.sortWithinPartitions(*self.keys)

    def _write_run(self, rows: DataFrame, fold_first: bool = False) -> str:
        """``_run_rows`` in files of at most ``FILE_CELLS`` rows, which bounds what a task that reads them has to shuffle."""
        name = f"run-{uuid.uuid4().hex}"
        with shuffles_freed(self.spark):
            (self._run_rows(rows, fold_first).write.option("maxRecordsPerFile", FILE_CELLS)
             .option("parquet.bloom.filter.enabled#" + self.keys[0], "true").parquet(f"{self.path}/runs/{name}"))
        return name

    def _put(self, rows: DataFrame, fold_first: bool) -> str:
        at = self._last()
        # through a one-row generator: a key that is a literal (a family) would be grouped as a constant, and dealt again for it
        run = self._write_run(rows.select(F.inline(F.array(F.struct(*self.schema.fieldNames())))), fold_first)
        self._commit([*self.runs(), run], at)
        return run

    def put(self, rows: DataFrame) -> str:
        """Insert or update ``rows``; of several rows of one key the greatest version stays.

        ``rows`` are computed up to three times (for hot keys, for the ranges, for the run), unless a shuffle
        already holds them: what is costly to compute is better written first."""
        rows = rows.select(*self.schema.fieldNames())
        return self._put(rows, self._has_hot_key(rows))

    def update(self, where: Column, changes: dict[str, Column], version: Column) -> str:
        """The stored rows that match get new values as a new version; all others stay as they are."""
        old = self.read().where(where)
        new = old.withColumns({**changes, self.version: version}).select(*self.schema.fieldNames())
        # a read has one row per key: only a change of the keys can make one hot
        return self._put(new, bool(set(changes) & set(self.keys)) and self._has_hot_key(new))

    def compact(self) -> None:
        """Fold all runs into one.  Readers of the old manifest keep their files until ``vacuum``."""
        at, runs = self._last(), self.runs()
        if len(runs) > 1:
            self._commit([self._write_run(self._all_versions(runs))], at)

    def vacuum(self) -> list[str]:
        """Delete runs that the last manifest does not name, and older manifests.  Only for a time without
        writers and readers of older states: a run being written is in no manifest yet."""
        kept = set(self.runs())
        gone = [n for n in self._names("runs") if n not in kept]
        for name in gone:
            self._fs.delete(self._hadoop.Path(f"{self.path}/runs/{name}"), True)
        for name in self._manifests()[:-1]:
            self._fs.delete(self._hadoop.Path(f"{self.path}/manifest/{name}"), False)
        return gone

    # ---- reading ----

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Per key the row of the greatest (version, run, other columns)."""
        order = [self.version, *(["_run"] if "_run" in rows.columns else [])]
        rest = [c for c in self.schema.fieldNames() if c not in (*self.keys, self.version)]
        best = rows.groupBy(*self.keys).agg(F.max(F.struct(*order, *rest)).alias("_b"))
        return best.select(*[F.col(c) if c in self.keys else F.col("_b").getField(c).alias(c) for c in self.schema.fieldNames()])

    def _stored(self, run: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/runs/{run}")

    def _all_versions(self, runs: list[str]) -> DataFrame:
        """The rows of the runs, with the run's place in ``_run``."""
        rows = self._stored(runs[0]).withColumn("_run", F.lit(0))
        for i, run in enumerate(runs[1:], 1):
            rows = rows.unionByName(self._stored(run).withColumn("_run", F.lit(i)))
        return rows

    def _merged(self, runs: list[str]) -> DataFrame:
        """A key has at most one row in each run, so none is hot: ranges of keys, whose rows of one key lie
        together, are less than half of what dealing by hash sends."""
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        if len(runs) == 1:
            return self._stored(runs[0])
        rows = self._all_versions(runs)
        return self._newest(rows.repartitionByRange(*self.keys) if self._range_keys else rows)

    def read(self) -> DataFrame:
        """The table as last committed: one row per key."""
        return self._merged(self.runs())
