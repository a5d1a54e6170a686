"""Size-checked broadcast.

A side is broadcast only after its row count is measured and found under a
limit; beyond it the caller's shuffle join runs (with AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000


_COUNTS: dict[tuple, int] = {}


def bounded_count(df: DataFrame, limit: int) -> int:
    """``min(count(df), limit + 1)``, reading at most ``limit + 1`` rows.

    Remembered per application for the same plan over the same input files
    (Parquet files are never rewritten in place, so new data means new files
    and a new key); a plan without input files is always counted.
    """
    files = tuple(sorted(df.inputFiles()))
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), files, limit) if files else None
    if key is not None and key in _COUNTS:
        return _COUNTS[key]
    n = df.limit(limit + 1).count()
    if key is not None:
        _COUNTS[key] = n
    return n


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Return ``(broadcast(df), True)`` when ``df`` has at most ``max_rows`` rows."""
    if bounded_count(df, max_rows) <= max_rows:
        return F.broadcast(df), True
    return df, False
