"""Line deduplication by content-defined chunks (operator 6), DataFrame functions only.

A document is cut into lines, and every ``WINDOW`` lines in a row are hashed at every
line.  A chunk ends after a line where the window over it and the next line occurs
nowhere else, so chunks are the longest stretches in which each window is repeated
somewhere in all documents.  Boundaries depend on content alone, so a passage
inserted above shifts nothing below, and a repeated block of ``WINDOW`` lines or more
lies in a chunk whole, whatever stands around it.

Inside the chunks a window that is not its first occurrence (smallest doc_id, then
position) is removed.  So of every run of at least ``WINDOW`` lines that occurs more than once
all lines go but for the first occurrence, of which only lines go that stand
in a window of an earlier one.  Single repeated lines stay.

Hashes only find candidates: windows with a repeated 64-bit hash are grouped by
their bytes, and only equal bytes are removed.  The aggregates are partial
before each shuffle, so one window in a third of all documents is one row per
task.  Only repeated windows' texts are shuffled, and each document once.

Defined results: null text stays null, with no lines; empty text is one empty
line; rows with equal doc_id and text are one document repeated, and all copies
lose the same lines; a null doc_id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import saved

WINDOW = LEAST = 2


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns that later expressions read instead of repeating
    (a one-row generator: the optimizer does not inline through it)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def window_hashes() -> Column:
    """Hashes of the ``WINDOW`` lines from each line on, in order."""
    tail = lambda k: F.slice("lines", F.lit(k + 1), F.greatest(F.size("lines") - (WINDOW - 1), F.lit(0)))
    rolled = F.transform(tail(0), lambda x: F.xxhash64(x))
    for k in range(1, WINDOW):
        rolled = F.zip_with(rolled, tail(k), lambda h, x: F.xxhash64(h, x))
    return rolled


def with_repeats(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, row, text)`` that hold a repeated window, plus ``lines`` and ``ats``: the lines where one begins."""
    lines = staged(rows, lines=F.split("text", "\n", -1))
    slim = saved(lines.select("row", F.posexplode(window_hashes()).alias("at", "hash")), "chunk-hashes")
    many = slim.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    found = saved(slim.join(many, "hash").groupBy("row").agg(F.collect_set("at").alias("ats")), "chunk-rows")
    # one strategy at every size: each document is shuffled once, to the key of its row
    return lines.join(found.hint("merge"), "row")


def with_chunks(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, row, text)`` plus ``lines``, and per chunk ``cuts``: lines before it and lines in it."""
    repeats = with_repeats(rows).select("row", "ats").distinct()
    parts = staged(rows.join(repeats, "row", "left"), lines=F.split("text", "\n", -1))
    # a window holds together the lines it begins and ends with
    inner = lambda i: F.exists("ats", lambda a: (a < i) & (i < a + WINDOW))
    parts = staged(parts, starts=F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.coalesce(inner(i), F.lit(False))))
    after = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("lines")))
    return staged(parts, cuts=F.zip_with("starts", after, lambda b, e: F.struct(b.alias("start"), (e - b).alias("lines")))).drop("starts", "ats")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, per row."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    # the texts of repeated windows, compared by their bytes
    texts = with_repeats(rows.where("text is not null")).select("doc_id", "row", F.inline(F.transform(
        "ats", lambda a: F.struct(a.alias("at"), F.array_join(F.slice("lines", a + 1, F.lit(WINDOW)), "\n").alias("chunk")))))
    texts = saved(texts, "chunk-texts")
    first = (texts.groupBy("chunk").agg(F.min(F.struct("doc_id", "at", "row")).alias("first"), F.count("*").alias("times"))
             .where("times > 1").select("chunk", "first"))
    gone = (texts.join(first, "chunk").where("not (row = first.row and at = first.at)").select("row", "at").distinct()
            .select("row", F.explode(F.sequence("at", F.col("at") + WINDOW - 1)).alias("at"))
            .groupBy("row").agg(F.collect_set("at").alias("gone")))
    keyed = staged(rows.join(gone.hint("merge"), "row", "left"), lines=F.split("text", "\n", -1))
    keyed = staged(keyed, left=F.when(F.col("gone").isNotNull(), F.filter("lines", lambda _, i: ~F.array_contains("gone", i))))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    return keyed.select("doc_id", lines.cast("long").alias("n_lines"),
                        F.when(F.col("left").isNull(), 0).otherwise(lines - F.size("left")).cast("long").alias("n_removed"),
                        F.coalesce(F.array_join("left", "\n"), F.col("text")).alias("text"))
