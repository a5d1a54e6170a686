"""Latest row per key.

Rows with one row key collapse into one stored row, as puts to one key do in
a key-value store.  The winner is the row with the latest time, ties broken
by the remaining columns, so the result is deterministic.  ``hits`` keeps how
many rows fell on the key, so both count meanings survive: ``visits``
(distinct keys) and ``page_views`` (sum of hits).

It is one aggregate, ``max(struct(order..., payload...))``, which Spark runs
as a partial aggregate before the shuffle: a key holding a third of all rows
is reduced inside each map task and never lands whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   hits_col: str | None = "hits") -> DataFrame:
    """One row per ``keys``: the max by ``order`` then by every other column."""
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    aggs = [F.max(packed).alias("_w")]
    if hits_col:
        aggs.append(F.count(F.lit(1)).alias(hits_col))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys]
    cols += [F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order)]
    cols += [F.col(f"_w.{c}").alias(c) for c in rest]
    if hits_col:
        cols.append(F.col(hits_col))
    return out.select(*cols)
