"""Key-value table operators on a long cell table.

A cell is ``(rowkey, family, qualifier, value, ts)``.  Writes append cells;
an update is a newer cell; reads take the latest version per
(rowkey, family, qualifier).  Stored sorted by row key (see
``loglark.sinks.tables.write_sorted_cells``), point, range and prefix reads
are pushed to the Parquet scan as min/max skipping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.schemas import CELL

# ---- wide <-> cells ---------------------------------------------------------


def to_cells(wide: DataFrame, columns: Sequence[str], family: str, key: str = "rowkey",
             ts: Column | None = None) -> DataFrame:
    """One cell per non-NULL column (a NULL column stores no cell)."""
    ts_col = (ts if ts is not None else F.lit(0)).cast("bigint").alias("ts")
    base = wide.select(F.col(key).alias("rowkey"), ts_col, *[F.col(c).cast("string") for c in columns])
    cells = base.unpivot(["rowkey", "ts"], list(columns), "qualifier", "value")
    return (cells.where(F.col("value").isNotNull())
                 .select("rowkey", F.lit(family).alias("family"), "qualifier", "value", "ts"))


def to_sorted_cells(wide: DataFrame, columns: Sequence[str], family: str, key: str = "rowkey",
                    ts: Column | None = None, partitions: int | None = None) -> DataFrame:
    """P8 in the order (rowkey, family, qualifier), for rows of unique keys.

    The rows are dealt by key ranges and sorted before they are cut into cells, so one row is shuffled
    and sorted, not one per column.
    """
    ranged = wide.repartitionByRange(partitions, key) if partitions else wide.repartitionByRange(key)
    return to_cells(ranged.sortWithinPartitions(key), sorted(columns), family, key, ts)


def families_to_cells(wide: DataFrame, families: dict[str, Sequence[str]], key: str = "rowkey",
                      ts: Column | None = None) -> DataFrame:
    """Rows with columns in several families -> cells, one pass."""
    ts_col = (ts if ts is not None else F.lit(0)).cast("bigint")
    entries = [F.struct(F.lit(fam).alias("family"), F.lit(q).alias("qualifier"),
                        F.col(q).cast("string").alias("value"))
               for fam, cols in families.items() for q in cols]
    out = wide.select(F.col(key).cast("string").alias("rowkey"), ts_col.alias("ts"), F.explode(F.array(*entries)).alias("_c"))
    return (out.where(F.col("_c.value").isNotNull())
               .select("rowkey", "_c.family", "_c.qualifier", "_c.value", "ts"))


def cells_to_wide(cells: DataFrame, columns: Sequence[str], family: str | None = None) -> DataFrame:
    """Latest cells -> one row per row key, one column per qualifier.

    The qualifier list is given, so ``pivot`` needs no extra job to find it;
    a missing cell reads back as NULL.
    """
    c = cells if family is None else cells.where(F.col("family") == family)
    return c.groupBy("rowkey").pivot("qualifier", list(columns)).agg(F.max("value"))


def row_to_map(columns: Sequence[str]) -> Column:
    """The row's columns as ``map(qualifier -> value)``."""
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])


# ---- versions ---------------------------------------------------------------


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest version per (rowkey, family, qualifier); ties by value.

    A partial aggregate: repeated puts of a hot row are folded map-side.
    """
    g = cells.groupBy("rowkey", "family", "qualifier").agg(F.max(F.struct("ts", "value")).alias("_v"))
    return g.select("rowkey", "family", "qualifier", F.col("_v.value").alias("value"), F.col("_v.ts").alias("ts"))


def latest_columns(puts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """W2 on wide rows: ``puts(rowkey, ts, *columns)`` -> per row key the newest
    non-null version of each column as ``struct(ts, value)``.  Rows are reduced
    wide, one partial aggregate, before anything is cut into cells."""
    versions = [F.max(F.when(F.col(c).isNotNull(), F.struct("ts", F.col(c).cast("string").alias("value")))).alias(c) for c in columns]
    return puts.groupBy("rowkey").agg(*versions)


def latest_wide(cells: DataFrame, columns: Sequence[str], family: str) -> DataFrame:
    """W2 + P9 in one aggregate: the newest version of each column of each row.

    One ``max(struct(ts, value))`` per qualifier, grouped by row key only, so
    there is a single shuffle (with map-side partial aggregation) instead of
    one for the versions and another for the pivot.  Same result as
    ``cells_to_wide(latest_cells(cells), columns, family)``.
    """
    fam = cells.where(F.col("family") == family)
    aggs = [F.max(F.when(F.col("qualifier") == q, F.struct("ts", "value"))).alias(q) for q in columns]
    wide = fam.groupBy("rowkey").agg(*aggs)
    return wide.select("rowkey", *[F.col(f"{q}.value").alias(q) for q in columns])


def put(cells: DataFrame, new_cells: DataFrame) -> DataFrame:
    """A put is an append; the newer ``ts`` wins on read."""
    return cells.unionByName(new_cells.select(*CELL.fieldNames()))


def update_cell(spark: SparkSession, cells: DataFrame, rowkey: str, family: str, qualifier: str,
                value: str, ts: int) -> DataFrame:
    """Update one cell of one row, others unchanged."""
    new = spark.createDataFrame([(rowkey, family, qualifier, value, ts)], CELL)
    return put(cells, new)


# ---- reads (F1-F8) ----------------------------------------------------------


def get_row(cells: DataFrame, rowkey: str, family: str | None = None,
            qualifier: str | None = None) -> DataFrame:
    """all cells of one row (optionally one family / column)."""
    cond = F.col("rowkey") == rowkey
    if family is not None:
        cond = cond & (F.col("family") == family)
    if qualifier is not None:
        cond = cond & (F.col("qualifier") == qualifier)
    return cells.where(cond)


def get_rows(cells: DataFrame, keys: DataFrame, max_keys: int = 1_000_000,
             single_row: bool = False, salt: int = 8) -> DataFrame:
    """F1 for many keys at once: a semi join with a frame of row keys.

    The key frame is broadcast only after its size is checked, unless the
    caller passes ``single_row=True`` for a frame that has one row by
    construction (a global aggregate), whose bound needs no count.  Beyond
    the limit the join shuffles on (rowkey, salt) with the keys repeated once
    per salt value, so a row holding a third of all cells is spread over
    ``salt`` partitions; the salt only steers placement, not the result.
    """
    from loglark.operators.sizing import broadcast_if_small

    k = keys.select("rowkey").distinct()
    if single_row:
        return cells.join(F.broadcast(k), "rowkey", "left_semi")
    k, small = broadcast_if_small(k, max_keys)
    if small or salt <= 1:
        return cells.join(k, "rowkey", "left_semi")
    c = cells.withColumn("_salt", F.pmod(F.xxhash64(*cells.columns), F.lit(salt)))
    ks = k.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return c.join(ks, ["rowkey", "_salt"], "left_semi").drop("_salt")


def scan_column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """every row's value of one column."""
    return cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier)).select("rowkey", "value")


def scan_family(cells: DataFrame, family: str) -> DataFrame:
    """all cells of one family."""
    return cells.where(F.col("family") == family)


def scan_from(cells: DataFrame, start: str) -> DataFrame:
    """rows with key >= start."""
    return cells.where(F.col("rowkey") >= start)


def scan_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """rows with start <= key < stop."""
    return cells.where((F.col("rowkey") >= start) & (F.col("rowkey") < stop))


def key_prefixes(pattern: str, most: int = 64) -> list[str]:
    """The literal beginnings of which every key that matches ``pattern`` has one; empty if none is certain.

    Reads ``^`` and then plain characters, escaped punctuation and small character classes up to the
    first thing that may match more than one text (a group, a dot, a repetition).  A pattern
    with an alternative is not read.
    """
    if not pattern.startswith("^") or "|" in pattern:
        return []
    found, i = [""], 1
    while i < len(pattern):
        c = pattern[i]
        if c == "[":
            end = pattern.find("]", i + 1)
            members = _class_members(pattern[i + 1:end]) if end > 0 else None
            step = end + 1 - i
        elif c == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            members, step = [pattern[i + 1]], 2
        elif c.isalnum() or c in "_-:#/%@=,;<>~!'\" ":
            members, step = [c], 1
        else:
            break
        after = pattern[i + step:i + step + 1]
        if members is None or after in ("?", "*", "{") or len(found) * len(members) > most:
            break
        found, i = [f + m for f in found for m in members], i + step
        if after == "+":
            break
    return found if found != [""] else []


def _class_members(body: str) -> list[str] | None:
    """The characters of ``[body]``: letters, digits, ``_`` and ranges of them; None for anything else."""
    plain = lambda c: c.isascii() and (c.isalnum() or c == "_")
    out, i = [], 0
    while i < len(body):
        first = last = body[i]
        if body[i + 1:i + 2] == "-" and i + 2 < len(body):
            last, i = body[i + 2], i + 2
        if not (plain(first) and plain(last)):
            return None
        out += [chr(c) for c in range(ord(first), ord(last) + 1)]
        i += 1
    return sorted(set(out)) or None


def scan_regex(cells: DataFrame, pattern: str) -> DataFrame:
    """rows whose key matches a regular expression.  The literal beginnings of the pattern are
    filters of their own, which Parquet evaluates (``StringStartsWith``), so row groups of other keys are skipped."""
    hit = F.col("rowkey").rlike(pattern)
    prefixes = key_prefixes(pattern)
    return scan_prefix_any(cells, prefixes).where(hit) if prefixes else cells.where(hit)


def scan_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """rows whose key starts with ``prefix`` (pushed down as StringStartsWith)."""
    return cells.where(F.col("rowkey").startswith(prefix))


def scan_prefix_any(cells: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """F8: OR of prefix filters (MUST_PASS_ONE)."""
    cond = None
    for p in prefixes:
        c = F.col("rowkey").startswith(p)
        cond = c if cond is None else (cond | c)
    return cells.where(cond)


# ---- catalog (T3, T4) -------------------------------------------------------


def list_families(cells: DataFrame) -> DataFrame:
    """T4: the families present in a cell table."""
    return cells.select("family").distinct()


def create_table_if_missing(spark: SparkSession, path: str) -> DataFrame:
    """An empty cell table at ``path`` unless one exists; returns it."""
    from loglark.sinks.tables import table_exists

    if not table_exists(spark, path):
        spark.createDataFrame([], CELL).write.mode("ignore").parquet(path)
    return spark.read.schema(CELL).parquet(path)
